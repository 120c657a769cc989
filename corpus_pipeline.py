"""The corpus pipeline: classify, remove near duplicates, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next stage's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sievework.llm.common import remove, shared_dir, table
from sievework.llm.decontaminate import decontaminate
from sievework.llm.mixing import mix
from sievework.llm.quality import quality_filter
from sievework.llm.simhash import near_dedup
from sievework.llm.token_store import token_digest


# Every stage takes rows as they come: null ids and texts, empty and very long texts, ties, repeated rows, further columns of
# any name, and empty tables, as its operator's docstring says; what is particular to a stage is said below.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, in the columns of docs. A null text is one of no words; null sources and
    languages are sites of their own; repeated rows are judged alike. An empty table stays empty; without labels for any
    of docs all stay."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id; of repeated rows one. A row without an id yields
    to one with an id. Texts without words (null ones too) are one group. An empty table stays empty."""
    return near_dedup(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. A null text has none, and stays; repeated rows are judged alike. An empty
    table stays empty; with an empty benchmark all stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source targets ask for, 3 times at most (repeated rows: 3 times as often at most). Null
    texts have size 0; null sources are one source. An empty table stays empty, and so does one without any words."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as binary blocks in the shared folder; per document its start, length and checksum, read back from them. A
    null text is the end id alone; null ids come last; repeated rows stay, next to each other. An empty table gives no
    rows."""
    return token_digest(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again; what a stage has read is
    deleted when it has written."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        if k:
            remove(spark, f"{base}/{k - 1}-{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
