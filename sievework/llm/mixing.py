"""Mixing sources to target weights by systematic sampling (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import common as C

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
#: Slices of a size class: a class with a third of 10**10 rows still ranks a few million rows at a time.
SLICES = 4096


def numbered(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """Numbers from 0 in the order of by: ranges number their own rows, and the ranges' counts say where each begins. The
    dealt rows are written once, so both come from the same deal."""
    dealt = C.checkpointed(df.repartitionByRange(C.partitions(df.sparkSession), *by).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    base = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1
    return dealt.withColumn("_place", place).join(F.broadcast(base), "_part").withColumn(name, F.col("_place") + F.col("_base")).drop("_part", "_place", "_base")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets of (source, source_size): sources by code point, null last, take the weights in turn and share the sum of
    sizes; a target stops at cap times its size and the excess is shared again by weight, until none is above.

    Each round of sharing is one sum over the sources, of which four numbers reach the driver, so sources may be as many
    as hosts are. Sizes stay whole numbers, and one division makes a target.
    """
    order = [F.col("source").isNull(), F.col("source")]
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_k") % len(weights) + 1).cast("int")).cast("long")
    w = C.checkpointed(numbered(sizes, order, "_k").select("source", "source_size", turn.alias("weight")))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    total = int(w.agg(F.sum(wide("source_size"))).first()[0] or 0)
    full, capped_weight, all_weight = 0, 0, int(w.agg(F.sum("weight")).first()[0] or 0)
    capped = F.lit(False)
    while True:
        # a source is at its cap if, with those that were before at theirs, its share of the rest is above it
        rest, rest_weight = total - cap * full, all_weight - capped_weight
        capped = wide("weight") * F.lit(rest).cast("decimal(38,0)") > wide("source_size") * F.lit(cap * rest_weight).cast("decimal(38,0)")
        now = w.where(capped).agg(F.sum(wide("source_size")), F.sum("weight")).first()
        if (int(now[0] or 0), int(now[1] or 0)) == (full, capped_weight):
            break
        full, capped_weight = int(now[0] or 0), int(now[1] or 0)
    if all_weight == capped_weight:
        target = (cap * F.col("source_size")).cast("double")
    else:
        target = F.when(capped, (cap * F.col("source_size")).cast("double")).otherwise((F.lit(rest) * F.col("weight")).cast("double") / F.lit(float(rest_weight)))
    return w.select("source", "source_size", target.alias("target"))


def offset_of(source, seed: int):
    """The one random offset of a source, in [0, 1): from its name and the seed, so reruns agree."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def planned_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17, keep: tuple[Column, ...] = ()) -> DataFrame:
    """(id, source, size, source_size, target, copies, *keep): how often the mix takes each document.

    Each document of a source is expected target / source_size times. In an order by size class (sizes of equal length
    and leading three digits), slice and id, the running sum of expected copies plus the source's offset crosses whole
    numbers; a document is taken once per crossing, so never more than cap times, and every size class gives its share.
    Ranks are sums over three levels (classes of a source, slices of a class, rows of a slice), each grouped before it
    is summed, so no task ranks the rows of a large source or of a large group of copies.

    Null texts have size 0, null sources are one source; rows without an id are sliced by their text and come last in
    their slice. Repeated rows count each; they are ranked as one row with a count. keep: named columns over docs to carry.
    A source without words has target 0 and takes nothing; so does every source if there are no words at all.
    """
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    slice_ = F.conv(F.substring(F.md5(F.coalesce(ident.cast("string"), text.cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10).cast("int") % SLICES
    d = docs.select(ident.alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size"), slice_.alias("slice"), *keep)
    own = [c for c in d.columns if c not in ("id", "source", "size", "slice")]
    digits = F.col("size").cast("string")
    d = d.withColumns({"class": F.length(digits) * 1000 + F.substring(digits, 1, 3).cast("int"), "source_key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))})
    d = d.groupBy("source_key", "source", "class", "slice", "id", "size", *own).agg(F.count("*").alias("m"))
    d = C.checkpointed(d)  # the texts are read once; what follows reads (id, source, size) rows several times
    slices = d.groupBy("source_key", "source", "class", "slice").agg(F.sum("m").alias("n"), F.sum(F.col("size") * F.col("m")).alias("words"))
    classes = slices.groupBy("source_key", "source", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    targets = targets.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("source_key"), "source_size", "target")
    before = lambda keys, *by: Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("class_base", F.coalesce(F.sum("n").over(before(["source_key"], "class")), F.lit(0)))
    slices = slices.withColumn("slice_base", F.coalesce(F.sum("n").over(before(["source_key", "class"], "slice")), F.lit(0)))
    base = slices.join(classes.select("source_key", "class", "class_base"), ["source_key", "class"]).join(targets, "source_key")
    base = base.select("source_key", "class", "slice", (F.col("class_base") + F.col("slice_base")).alias("base"), "source_size", "target")
    row = before(["source_key", "class", "slice"], F.col("id").asc_nulls_last(), "size", *own)
    ranked = d.withColumn("rank", F.coalesce(F.sum("m").over(row), F.lit(0))).join(base, ["source_key", "class", "slice"])
    ranked = ranked.withColumn("last", F.explode(F.sequence(F.col("base") + F.col("rank") + 1, F.col("base") + F.col("rank") + F.col("m"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda k: F.floor(rate * k + offset_of(F.col("source"), seed))
    return ranked.select("id", "source", "size", "source_size", "target", (upto(F.col("last")) - upto(F.col("last") - 1)).cast("long").alias("copies"), *own)


def row_key(docs: DataFrame) -> list[Column]:
    """128 bits of a row's content: equal rows alone have equal keys. Maps have no order to hash and are left out: rows that
    differ in maps alone count as repeated ones."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(*cols).alias("key_a"), F.xxhash64(F.lit("b"), nulls, *cols).alias("key_b")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """The mix itself: each row of docs as often as planned_copies says, in the columns of docs, whatever they are called.

    Rows meet their plan by a hash of their whole content, so null ids or one id of many rows are no hot key. Repeated rows
    are one row to the mix, taken as often as all of them together. Null ids and texts, empty tables: as planned_copies.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(docs))
    copies = planned_copies(docs, id_col, text_col, source_col, weights, cap, seed, tuple(row_key(docs)))
    plan = copies.groupBy("key_a", "key_b").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    keys = ["key_a", "key_b"]
    once = named.join(plan.where("rows = 1"), keys).select("row", "copies")
    again = named.join(plan.where("rows > 1").select(*keys), keys, "left_semi").groupBy(*keys).agg(F.first("row").alias("row")).join(plan, keys).select("row", "copies")
    taken = once.unionByName(again)
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*C.out_of_one(docs.columns))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = planned_copies(C.table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM d GROUP BY source),
t AS (SELECT sum(source_size)::BIGINT AS total FROM s),
r AS (SELECT 0 AS round, source, source_size, weight, false AS capped FROM s
      UNION ALL
      SELECT round + 1, source, source_size, weight, capped OR (total - 3 * full_size) * weight > 3 * source_size * free_weight
      FROM (SELECT *, coalesce(sum(source_size) FILTER (capped) OVER (), 0) AS full_size, coalesce(sum(weight) FILTER (NOT capped) OVER (), 0) AS free_weight FROM r), t WHERE round < 40),
e AS (SELECT source, source_size, weight, capped, coalesce(sum(source_size) FILTER (capped) OVER (), 0) AS full_size, coalesce(sum(weight) FILTER (NOT capped) OVER (), 0) AS free_weight FROM r WHERE round = 40),
g AS (SELECT source, source_size, CASE WHEN capped OR free_weight = 0 THEN (3 * source_size)::DOUBLE ELSE ((total - 3 * full_size) * weight)::DOUBLE / free_weight::DOUBLE END AS target FROM e, t),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY len(size::VARCHAR) * 1000 + left(size::VARCHAR, 3)::INT, ('0x' || left(md5(coalesce(doc_id::VARCHAR, text, '')), 3))::INT, doc_id NULLS LAST, size) AS n FROM d),
o AS (SELECT k.doc_id, k.size, g.source_size, g.target, n, CASE WHEN g.source_size > 0 THEN g.target / g.source_size::DOUBLE ELSE 0.0 END AS rate,
             ('0x' || left(md5('17:' || coalesce('s' || k.source, 'n')), 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ((floor(rate * n + u) - floor(rate * (n - 1) + u))::BIGINT * size)::BIGINT AS taken FROM o
"""
