"""The gated curation flow, with deterministic rules in the place of services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import text as X
from sievework.operators import records as R


def gated_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check translations for lost numbers and lost length, derive a verdict, let only what needs an edit through the
    repair stage, pick a candidate, and settle on a final text. Every document comes out, once."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.concat("text", F.lit(" 1,000.5")).alias("source_text"))
    cut = F.when(F.col("doc_id") % 3 == 0, F.expr("left(source_text, cast(length(source_text) div 2 as int))")).otherwise(F.col("source_text"))
    d = d.withColumn("target_text", F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("source_text", "[0-9]", "")).otherwise(cut))
    misses = X.pattern_misses(F.col("source_text"), F.col("target_text"), ("number",))
    short = F.length("target_text") / F.length("source_text") < 0.6
    issue = lambda c, s: F.when(c, F.struct(F.lit(s).alias("severity")))
    issues = F.filter(F.array(issue(F.col("lost"), "major"), issue(short, "minor")), lambda x: x.isNotNull())
    d = d.withColumn("lost", F.size(misses) > 0)
    d = d.withColumn("gate_answer", F.struct(issues.alias("issues"), F.lit("publishable").alias("verdict")))
    d = R.derive_verdict(d)
    d = R.set_when(d, "lost and len(source_text) < 20", {"gate_answer.verdict": "hopeless"})
    d = R.select_input(d, [("gate_answer.verdict == 'needs_edit'", "pass")])
    d = R.candidates(d, "candidates", ["target_text", "source_text"], "C")
    d = R.select_by_id(d.withColumn("choice", F.lit("C2")), "choice", "candidates", "picked")
    d = R.fold_errors(d, "repair")
    d = R.fold_errors(R.coalesce_fields(d, "final_text", ["picked", "target_text"]), "final")
    return d.select("doc_id", F.col("gate_answer.verdict").alias("verdict"), F.length("final_text").cast("long").alias("final_chars"), F.md5("final_text").alias("final_md5"), F.coalesce("error", F.lit(False)).alias("error"))


FLAGSHIP_SQL = """
WITH d AS (SELECT doc_id, text || ' 1,000.5' AS s FROM documents),
t AS (SELECT doc_id, s, CASE WHEN doc_id % 2 = 0 THEN regexp_replace(s, '[0-9]', '', 'g') WHEN doc_id % 3 = 0 THEN left(s, length(s) // 2) ELSE s END AS t FROM d),
v AS (SELECT *, CASE WHEN (doc_id % 2 = 0 OR doc_id % 3 = 0) THEN CASE WHEN length(s) < 20 THEN 'hopeless' ELSE 'needs_edit' END ELSE 'publishable' END AS verdict FROM t),
f AS (SELECT *, CASE WHEN verdict = 'needs_edit' THEN s ELSE t END AS final_text FROM v)
SELECT doc_id, verdict, length(final_text)::BIGINT AS final_chars, md5(final_text) AS final_md5, false AS error FROM f
"""
