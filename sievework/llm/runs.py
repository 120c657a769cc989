"""Periodic run detection by power-of-two names of word sequences (operator 13)."""

from __future__ import annotations

from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"
LEAST = 24
TIMES = 3
#: Words that are named together, so that short documents share the cost of a NumPy call.
TOGETHER = 1 << 18
#: Pairs of places that are compared at once.
PAIRS = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def name_levels(ids: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(names, repeated): names[j][i] names the 2**j ids from place i; repeated[j]: the places whose name is not theirs alone.

    A name of level j is that of the pair of names of level j - 1, by the pair's rank among all such pairs (Karp, Miller,
    Rosenberg). A place whose name is its own alone keeps a number of its own on all higher levels, so only places that
    still repeat are ranked, and levels end where none does.
    """
    n = len(ids)
    own = np.arange(n, 2 * n, dtype=np.int32 if n < 1 << 30 else np.int64)
    names, repeated = [], []
    at, key = np.arange(n), ids.astype(np.int64)
    while len(at):
        _, rank, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[rank] > 1
        at = at[again]
        name = own.copy()
        name[at] = rank[again]
        names.append(name)
        repeated.append(at)
        half = 1 << (len(names) - 1)
        live = np.zeros(n + half, bool)
        live[at] = True
        at = at[live[at + half]]
        key = name[at] * np.int64(2 * n) + name[at + half]
    return names, repeated


def common_ahead(names: list[np.ndarray], i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How many ids agree from i and from k on (k > i), by descending levels."""
    got, last = np.zeros(len(i), np.int64), len(names[0]) - 1
    for level in range(len(names) - 1, -1, -1):
        at = k + got
        hit = (at <= last) & (names[level][np.minimum(i + got, last)] == names[level][np.minimum(at, last)])
        got += hit.astype(np.int64) << level
    return got


def common_behind(names: list[np.ndarray], i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How many ids agree just before i and just before k (k > i), by descending levels."""
    got = np.zeros(len(i), np.int64)
    for level in range(len(names) - 1, -1, -1):
        at = i - got - (1 << level)
        hit = (at >= 0) & (names[level][np.maximum(at, 0)] == names[level][np.maximum(at, 0) + k - i])
        got += hit.astype(np.int64) << level
    return got


def grid(start: int, size: int, level: int, lowest: int, times: int):
    """(places, periods) of one document and level, about PAIRS at a time: periods of 2**level up to twice that (on the lowest
    level all below too), places the multiples of the period, or of 2**level if that is more."""
    periods = np.arange(1 if level == lowest else 1 << level, min((2 << level) - 1, size // times) + 1)
    step = np.maximum(periods, 1 << level)
    points = np.maximum((size - periods - (1 << level)) // step + 1, 0)
    before = np.cumsum(points) - points
    edges = np.append(np.flatnonzero(np.diff(before // PAIRS, prepend=-1)), len(points))
    for a, b in zip(edges[:-1], edges[1:]):
        k = np.arange(points[a:b].sum()) - np.repeat(before[a:b] - before[a], points[a:b])
        yield start + k * np.repeat(step[a:b], points[a:b]), np.repeat(periods[a:b], points[a:b])


def gathered(parts):
    """Pairs of arrays, joined to about PAIRS items each."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= PAIRS:
            yield [np.concatenate(x) for x in zip(*held)]
            held, size = [], 0
    if size:
        yield [np.concatenate(x) for x in zip(*held)]


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, end, period), sorted, of all maximal runs of some documents, which lie one after the other in ids and have
    no id in common.

    A run of period p is times * p long at least (times: 3 or more), and least at any rate. So some multiple of p, counted
    from its document's start, lies among its first p places, and the 2**level <= p ids from there come again p further on.
    Periods below least / 3 share the lowest level, whose length is their grid. Pairs of places on the grid are tried by
    one comparison of names; those that agree are extended both ways. What a multiple of a run's period finds has the same
    ends as the run (Fine and Wilf), so the least period of equal ends is kept.
    """
    if times < 3:
        raise ValueError("a run is three periods long at least")
    found = [np.zeros((0, 3), np.int64)]
    starts, lowest = np.cumsum(sizes) - sizes, max(0, (least // 3).bit_length() - 1)
    names, repeated = name_levels(ids)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    for level in range(lowest, len(names)):
        live = np.unique(doc[repeated[level]])
        live = live[sizes[live] >= least]
        for i, p in gathered(x for d in live for x in grid(starts[d], sizes[d], level, lowest, times)):
            same = names[level][i] == names[level][i + p]
            i, p = i[same], p[same]
            begin, end = i - common_behind(names, i, i + p), i + p + common_ahead(names, i, i + p)
            full = end - begin >= np.maximum(least, times * p)
            found.append(np.unique(np.stack([begin[full], end[full], p[full]], 1), axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))] if len(rows) else rows


def runs_of(texts: list[bytes | None], least: int, times: int):
    """(words, runs, runs' bounds by text, collapsed texts) of some whole texts."""
    words = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ids, base = array("q"), 0
    for w in words:
        numbers = defaultdict(count(base).__next__)
        ids.extend(map(numbers.__getitem__, w))
        base += len(w)
    starts = np.cumsum(sizes) - sizes
    rows = find_runs(np.frombuffer(ids, np.int64), sizes, least, times) if ids else np.zeros((0, 3), np.int64)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    bounds = np.searchsorted(rows[:, 0], np.append(starts, len(ids)))
    kept = []
    for d, w in enumerate(words):
        if bounds[d] < bounds[d + 1]:
            w = [w[k] for k in np.flatnonzero(keep[starts[d] : starts[d] + sizes[d]])]
        kept.append(b" ".join(w))
    rows[:, 1] -= rows[:, 0]
    rows[:, 0] -= np.repeat(starts, np.diff(bounds))
    return sizes, rows, bounds, kept


def together(texts: pa.Array):
    """Slices (start, stop) of texts of about TOGETHER words, taken as 6 bytes each; a longer text is one alone."""
    start = size = 0
    for k, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if size and size + n > 6 * TOGETHER:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """docs with n_words, runs and collapsed of each whole text.

    Words are what stands between spaces, tabs, line ends and the like. A run is a stretch of consecutive words with the
    least period q (words q apart are equal), times * q and least words long at least, that no neighbouring word extends.
    runs: array of (start, length, period), in words from 0, by start and period; collapsed: the words that no run holds
    after its first q words, joined by one space.

    Row by row, without a shuffle. A task holds one batch, and about 9 numbers of 4 bytes a word and level of the texts named
    together; levels end where no sequence repeats. Null, empty and blank texts have no words, no runs and an empty
    collapsed text; repeated rows count alike; empty tables give no rows. Columns named n_words, runs or collapsed are
    replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    plain, texts = C.carried(docs, columns, text_col)

    def run(batches):
        C.drop_caches()
        for batch in batches:
            column = texts(batch).cast(pa.binary())
            for a, b in together(column):
                sizes, rows, bounds, kept = runs_of(column.slice(a, b - a).to_pylist(), least, times)
                runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), pa.array(sizes), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "runs", "collapsed"])

    schema = T.StructType([plain.schema["row"], T.StructField("n_words", T.LongType()), *T._parse_datatype_string("runs array<struct<start:long,length:long,period:long>>, collapsed string")])
    return plain.mapInArrow(run, schema).select(*C.out_of_one(columns), "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; ties: least start, then period. Null of none."""
    def better(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(left > right, -1).when(left < right, 1).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)

    return F.try_element_at(F.array_sort(runs, better), F.lit(1))


def planted(text: Column, key: Column) -> Column:
    """text, in which a tenth of the keys (those whose CRC-32 is divisible by 10) has a period from some word on; the others
    keep their text. A null key or text, and one without words, stays as it is."""
    h = F.crc32(key.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    g = F.floor(h / 10).cast("long")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    part = F.slice(words, a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / F.size(part)).cast("int"))), F.lit(1), (n - a).cast("int"))
    return F.when((h % 10 == 0) & F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")).otherwise(text)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = collapse_runs(docs).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = [F.col("best")[c].alias(c) for c in ("start", "length", "period")]
    milli = F.expr("(1000 * best.length) div best.period").alias("exponent_milli")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, milli, F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
