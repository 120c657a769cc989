"""Set logic of runs: resume, readiness, repair, merging of runs, progress and alerts, as plain relational queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import first_by
from sievework.operators.records import priority_rank
from sievework.sources.shared import checkpointed


def with_order(df: DataFrame, by: str, name: str = "_ord") -> DataFrame:
    """Consecutive numbers from 0 in the order of by, without one task for all rows: ranges number their own rows, and the
    ranges' sizes (one row each) give where each begins. The dealt rows are written to the shared folder once, range number
    and all, so that sizes and rows come from one deal. An empty frame has no numbers; nulls come first, as in orderBy."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(df.repartitionByRange(parts, by).withColumn("_order_part", F.spark_partition_id()))
    before = Window.orderBy("_order_part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_order_part").agg(F.count("*").alias("_n")).select("_order_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_order_base"))
    place = F.row_number().over(Window.partitionBy("_order_part").orderBy(by)) - 1
    local = dealt.withColumn(name, place).join(F.broadcast(base), "_order_part")
    return local.withColumn(name, F.col(f"`{name}`") + F.col("_order_base")).drop("_order_part", "_order_base")


def seed_chunks(df: DataFrame, order_col: str, field: str | None = None, order: list | None = None, size: int = 20) -> DataFrame:
    """Freeze an order: listed values of field first, then the rest; ids of 8 digits and chunks of 6 (or more, where there are
    as many) of size rows. All other columns stay, and every row comes out once."""
    rank = priority_rank(field, order or []) if field else F.lit(1)
    out = with_order(df.withColumn("_seed_key", F.struct(rank.alias("rank"), F.col(order_col).alias("order"))), "_seed_key", "_seed_pos").drop("_seed_key")
    pos, digits = F.col("_seed_pos"), lambda c, n: F.lpad(c.cast("string"), F.greatest(F.length(c.cast("string")), F.lit(n)), "0")
    return out.withColumns({"seed_id": digits(pos, 8), "chunk_id": digits(F.floor(pos / size), 6)}).drop("_seed_pos")


def resume(todo: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows not processed yet; flagged rows count as done."""
    keys = [key] if isinstance(key, str) else key
    return todo.join(done.select(*keys), keys, "left_anti")


def ready(targets: DataFrame, done: DataFrame, stage: int, key: str | list[str] = "chunk_id") -> DataFrame:
    """Chunks of targets that the stage before has done (any, for the first) and this one has not; key may name the job too."""
    keys = [key] if isinstance(key, str) else key
    at = lambda n: done.where(F.col("stage") == n).select(*keys)
    out = targets if stage == 0 else targets.join(at(stage - 1), keys, "left_semi")
    return out.join(at(stage), keys, "left_anti")


def missing_chunks(chunks: DataFrame, done: DataFrame, stages: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(*keys, stage, chunk_id): done by the stage before (all, for the first) but not by this one; keys may name the job."""
    at = [*keys, "stage", "chunk_id"]
    all_ = chunks.select(*keys, "chunk_id").distinct().withColumn("stage", F.lit(0)).select(*at)
    had = done.select(*keys, F.col("stage").cast("int").alias("stage"), "chunk_id")
    before = all_.unionByName(had.where(F.col("stage") < stages - 1).withColumn("stage", F.col("stage") + 1).distinct().select(*at))
    return before.join(had, at, "left_anti").select(*at)


def align_items(expected: DataFrame, replies: DataFrame, key: str, item: str) -> DataFrame:
    """Each expected item with the reply that echoes its id exactly once; none or several leave it unanswered."""
    once = replies.groupBy(key, item).agg(F.count("*").alias("n"), F.min("reply").alias("reply")).where("n = 1").drop("n")
    return expected.join(once, [key, item], "left").withColumn("answered", F.col("reply").isNotNull())


def combine_runs(runs: list[DataFrame], key: str) -> DataFrame:
    """One row per id over the base run and its reruns: the latest that is well, else the latest."""
    rows = [r.withColumn("_run", F.lit(i)) for i, r in enumerate(runs)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return first_by(out, [key], [F.coalesce("error", F.lit(False)).asc(), F.col("_run").desc()])


def pull_failed(inputs: DataFrame, last: DataFrame, key: str) -> DataFrame:
    """Original rows whose last stage failed, or that never arrived: those without a well row at the end."""
    return inputs.join(last.where(~F.coalesce("error", F.lit(False))).select(key), key, "left_anti")


def fill_gaps(base: DataFrame, fallback: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Blank texts from a fallback that is neither blank nor the source itself, with where each came from."""
    f = fallback.select(key, F.col(text).alias("_fb"))
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    use = blank(F.col(text)) & ~blank(F.col("_fb")) & (F.col("_fb") != F.col(source))
    return base.join(f, key, "left").withColumns({"origin": F.when(~blank(F.col(text)), "run").when(use, "fallback").otherwise("none"), text: F.when(use, F.col("_fb")).otherwise(F.col(text))}).drop("_fb")


def capability_match(tasks: DataFrame, workers: DataFrame) -> DataFrame:
    """(requires, n_workers) of each set of required tags, 0 where no worker has them all. Both sides are reduced to their
    distinct tag sets first; a task's tags join to workers by tag, and a worker that meets all of them is one that meets
    as many as there are, so no pair of unrelated sets is formed."""
    need = tasks.select("requires").distinct().withColumn("n", F.size(F.array_distinct("requires")))
    have = workers.select("worker_id", F.explode(F.array_distinct("capabilities")).alias("tag")).distinct()
    met = need.where("n > 0").select("requires", "n", F.explode(F.array_distinct("requires")).alias("tag")).join(have, "tag").groupBy("requires", "n", "worker_id").agg(F.count("*").alias("k")).where("k = n")
    some = met.groupBy("requires").agg(F.count("*").alias("n_workers"))
    free = need.where("n = 0").select("requires").join(F.broadcast(workers.agg(F.count_distinct("worker_id").alias("n_workers"))))
    return need.where("n > 0").select("requires").join(some, "requires", "left").select("requires", F.coalesce("n_workers", F.lit(0)).alias("n_workers")).unionByName(free)


def outage_chunks(rows: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Chunks where more than ratio of the rows that ran failed to connect."""
    ran = F.sum(F.when(~F.col("skipped"), 1).otherwise(0))
    bad = F.sum(F.when(~F.col("skipped") & F.col("connection_error"), 1).otherwise(0))
    out = rows.groupBy("chunk_id").agg(ran.alias("ran"), bad.alias("bad"))
    return out.where((F.col("ran") > 0) & (F.col("bad") > ratio * F.col("ran")))


def margin_ratio(a: DataFrame, b: DataFrame, id_col: str, vec_col: str, k: int = 4, block_rows: int = 8192) -> DataFrame:
    """(a_id, b_id, cosine, margin) of the pairs that are each other's nearest, over unit vectors.

    margin = cosine over the mean of both sides' mean cosine to their k nearest, ties by smaller id. Either side is dealt
    to blocks of about block_rows; a block of a meets a block of b in one task, which multiplies them once and gives the k
    best of each row and of each column, so no pair is ever a row. Null ids or vectors are left out."""
    import numpy as np
    import pyarrow as pa

    sides = [checkpointed(x.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))) for x in (a, b)]
    counts = [x.count() // block_rows + 1 for x in sides]
    dealt = []
    for x, own, other, n, m in ((sides[0], "ba", "bb", *counts), (sides[1], "bb", "ba", *counts[::-1])):
        dealt.append(x.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    def best(c, own, other, of_a):
        """The k largest of each row of c, with those that tie for the last place, cut by id."""
        top = np.argpartition(-c, min(k, c.shape[1]) - 1, axis=1)[:, : min(k, c.shape[1])]
        last = np.take_along_axis(c, top, axis=1).min(axis=1)
        row, col = np.nonzero(c >= last[:, None])
        order = np.lexsort((other[col], -c[row, col], row))
        row, col = row[order], col[order]
        start = np.searchsorted(row, np.arange(len(own)))
        use = np.arange(len(row)) - start[row] < k
        row, col = row[use], col[use]
        return {"of_a": np.full(len(row), of_a), "id": own[row], "other": other[col], "c": c[row, col]}

    def run(p: pa.Table, q: pa.Table) -> pa.Table:
        kinds = {"of_a": pa.bool_(), "id": pa.int64(), "other": pa.int64(), "c": pa.float64()}
        if not p.num_rows or not q.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds.items()})
        pv, qv = (t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (p, q))
        pi, qi = p.column("id").to_numpy(), q.column("id").to_numpy()
        found = []
        for s in range(0, len(pv), 1024):
            c = pv[s : s + 1024] @ qv.T
            found += [best(c, pi[s : s + 1024], qi, True), best(c.T, qi, pi[s : s + 1024], False)]
        return pa.table({n: pa.array(np.concatenate([x[n] for x in found]), t) for n, t in kinds.items()})

    near = dealt[0].groupBy("ba", "bb").cogroup(dealt[1].groupBy("ba", "bb")).applyInArrow(run, "of_a boolean, id long, other long, c double")
    place = Window.partitionBy("of_a", "id").orderBy(F.col("c").desc(), "other")
    near = checkpointed(near.withColumn("r", F.row_number().over(place)).where(F.col("r") <= k))
    mean = lambda of_a, name, key: near.where(F.col("of_a") == of_a).groupBy(F.col("id").alias(key)).agg(F.avg("c").alias(name))
    first = near.where("of_a and r = 1").select(F.col("id").alias("a_id"), F.col("other").alias("b_id"), F.col("c").alias("cosine"))
    back = near.where("not of_a and r = 1").select(F.col("id").alias("b_id"), F.col("other").alias("a_id"))
    pairs = first.join(back, ["a_id", "b_id"], "left_semi").join(mean(True, "ma", "a_id"), "a_id").join(mean(False, "mb", "b_id"), "b_id")
    return pairs.select("a_id", "b_id", "cosine", (F.col("cosine") / ((F.col("ma") + F.col("mb")) / 2)).alias("margin"))
