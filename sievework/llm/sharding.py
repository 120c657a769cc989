"""Rendezvous hashing of stable record keys over weighted shards (operator 11): DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import common as C
from sievework.llm.mixing import row_key

SHARDS = 24
#: Slices of all shards together, in which rows are numbered: 2**31 rows have some 16,000 a slice.
SLICE_BITS = 17
#: Equal rows that are numbered in one task; more are dealt out in runs of so many.
COPIES = 1 << 16


def checked(weights: Sequence[float], name: str) -> list[float]:
    if not weights or any(not 0 <= w < float("inf") for w in weights) or not any(weights):
        raise ValueError(f"{name}: one finite weight of 0 or more for each shard, and one above 0, are needed")
    return [float(w) for w in weights]


def rendezvous(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(score, shard) of the shard that a key meets. key: a 64-bit hash.

    Each shard draws for each key a number u in (0, 1] from the hash of both; the shard with the least -ln(u) / weight has
    the key. So a shard's share is its weight's, and a further shard (or a larger weight) takes keys, and gives none: the
    draws of the others stay. Equal scores go to the lower shard. A shard of weight 0 has no key. first: the number of the
    first shard. The plan has one expression, however many shards there are.
    """
    open_ = F.array(*[F.struct(F.lit(first + s).cast("long").alias("shard"), F.lit(w).alias("weight")) for s, w in enumerate(weights) if w])
    u = lambda s: (F.shiftrightunsigned(F.xxhash64(key, s["shard"]), 11) + 1).cast("double") / F.lit(2.0**53)
    return F.array_min(F.transform(open_, lambda s: F.struct((-F.log(u(s)) / s["weight"]).alias("score"), s["shard"].cast("int").alias("shard"))))


def shard_plan(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key_cols: Sequence[str] = ("doc_id",), keep: Sequence[Column] = ()) -> DataFrame:
    """(shard, slot, grown_shard, copies, *keep), one row for each row of docs.

    The key alone (key_cols) and the weights decide the shard. slot counts a shard's rows from 0 without a gap, in an order
    by hash of what is kept, so reruns agree. grown: the weights of a later layout, whose shard is grown_shard (else null).
    keep: named columns over docs, whose names are none of the above; copies: how many rows are equal in key and these.

    Rows are numbered in slices of each shard by hash; the slices' counts, at most 2**17 or one a shard, say where each
    begins. Equal rows are one row with a count until they have their numbers, so neither a shard, nor a key, nor a group
    of copies is ever one task's work. Texts are read once and not moved. Nulls in the key are a key of their own (rows
    with a null id are one shard's); empty tables give no rows; repeated rows have the same shard and a slot each.
    """
    weights = checked(weights, "weights")
    key = F.xxhash64(*[F.col(f"`{c}`") for c in key_cols])
    d = docs.select(key.alias("_key"), *keep)
    own = [c for c in d.columns if c != "_key"]
    d = d.withColumn("_met", rendezvous(F.col("_key"), weights))
    later = rendezvous(F.col("_key"), checked(grown, "grown"))["shard"] if grown is not None else F.lit(None).cast("int")
    bits = max(0, SLICE_BITS - (len(weights) - 1).bit_length())
    d = d.select("_key", F.col("_met")["shard"].alias("shard"), later.alias("grown_shard"), F.xxhash64("_key", *own).alias("_place"), *own)
    d = d.withColumn("_slice", F.shiftright("_place", 64 - bits) if bits else F.lit(0).cast("long"))
    keys = ["shard", "_slice"]
    d = C.checkpointed(d.groupBy(*keys, "_place", "_key", "grown_shard", *own).agg(F.count("*").alias("copies")))
    before = lambda k, *by: Window.partitionBy(*k).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    base = d.groupBy(*keys).agg(F.sum("copies").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before(["shard"], "_slice")), F.lit(0)))
    ranked = d.withColumn("_rank", F.coalesce(F.sum("copies").over(before(keys, "_place", "_key", *own)), F.lit(0)))
    ranked = ranked.join(F.broadcast(base.select(*keys, "_base")), keys).withColumn("_from", F.col("_base") + F.col("_rank"))
    return numbered(ranked).select("shard", "slot", "grown_shard", "copies", *own)


def numbered(ranked: DataFrame) -> DataFrame:
    """A row for each of the copies, slot counting from _from. Runs of COPIES rows are dealt out before they are unfolded."""
    few = ranked.where(F.col("copies") <= COPIES).withColumns({"_lo": F.lit(0).cast("long"), "_hi": F.col("copies") - 1})
    many = ranked.where(F.col("copies") > COPIES).withColumn("_lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    many = many.withColumn("_hi", F.least(F.col("_lo") + COPIES, "copies") - 1).repartition(C.partitions(ranked.sparkSession), "_from", "_lo")
    return few.unionByName(many).withColumn("slot", F.explode(F.sequence(F.col("_from") + F.col("_lo"), F.col("_from") + F.col("_hi"))))


def sharded(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """docs with shard, slot and grown_shard, which replace columns of these names that are no key.

    Rows meet their plan by a hash of their whole content, so null or repeated keys are no hot key; of equal rows one is
    taken and unfolded. Further columns may have any name. Else as shard_plan says.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot", "grown_shard")]
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    plan = shard_plan(docs, weights, grown, key_cols, [x.alias(f"_{i}") for i, x in enumerate(row_key(kept))])
    named = kept.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), *[x.alias(f"_{i}") for i, x in enumerate(row_key(kept))])
    keys, out = ["_0", "_1"], ["row", "shard", "slot", "grown_shard"]
    once = named.join(plan.where("copies = 1"), keys).select(*out)
    again = plan.where("copies > 1")
    first = named.join(again.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.first("row").alias("row"))
    return once.unionByName(again.join(first, keys).select(*out)).select(*C.out_of_one(columns), *out[1:])


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key_cols: Sequence[str] = ("doc_id",)) -> None:
    """Parquet files of each shard under path/shard=N, in the order of slots; a large shard is several tasks' work."""
    out = sharded(docs, weights, None, key_cols).drop("grown_shard")
    out.repartitionByRange(C.partitions(docs.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = [F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    out = shard_plan(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1), keep=keep)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def xxh64_sql(table: str, name: str, value: str, seed: str) -> str:
    """SQL of table with name, the XXH64 of a 64-bit value with a seed as an unsigned number; a null value leaves the seed."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in PRIMES)
    m = f"{2**64}::UHUGEINT"
    steps = (
        f"*, ({value})::HUGEINT AS v, ({seed})::UHUGEINT AS s",
        f"*, (v + CASE WHEN v < 0 THEN {2**64}::HUGEINT ELSE 0 END)::UHUGEINT * {p2} % {m} AS a",
        f"*, ((a << 31) % {m} + (a >> 33)) * {p1} % {m} AS b",
        f"*, xor((s + {p5} + 8) % {m}, b) AS c",
        f"*, (((c << 27) % {m} + (c >> 37)) * {p1} + {p4}) % {m} AS d",
        f"*, xor(d, d >> 33) * {p2} % {m} AS e",
        f"*, xor(e, e >> 29) * {p3} % {m} AS f",
        f"* EXCLUDE (v, s, a, b, c, d, e, f), CASE WHEN v IS NULL THEN s ELSE xor(f, f >> 32) END AS {name}",
    )
    for step in steps:
        table = f"(SELECT {step} FROM {table})"
    return table


OP11_SQL = rf"""
WITH RECURSIVE crc AS (SELECT b, 0 AS k, b::BIGINT AS c FROM range(256) r(b)
      UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
l AS (SELECT list(c ORDER BY b) AS l FROM crc WHERE k = 8),
b AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
d AS (SELECT doc_id, len(bytes)::BIGINT + 8 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, l[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, l),
k AS (SELECT row_number() OVER () AS r, * FROM {xxh64_sql("d", "k", "doc_id", "42")}),
o AS (SELECT * FROM {xxh64_sql(xxh64_sql(xxh64_sql(xxh64_sql("k", "h1", "k::HUGEINT - CASE WHEN k >= 9223372036854775808 THEN 18446744073709551616::HUGEINT ELSE 0 END", "42"), "h2", "doc_id", "h1"), "h3", "size", "h2"), "place", "text_crc32", "h3")}),
m AS (SELECT r, shard, hash >> 11 AS u FROM {xxh64_sql(f"(SELECT r, shard, h1 FROM o, range({SHARDS + 1}) t(shard))", "hash", "shard", "h1")}),
s AS (SELECT r, first(shard ORDER BY u DESC, shard) FILTER (shard < {SHARDS}) AS shard, first(shard ORDER BY u DESC, shard) AS grown_shard FROM m GROUP BY r)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY place >= 9223372036854775808 DESC, place, k >= 9223372036854775808 DESC, k, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
FROM o JOIN s USING (r)
"""
