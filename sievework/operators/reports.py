"""Reports over runs: flagged counts, progress, dead letters, scores, comparisons, and the set logic of plans and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def count_of(count: str | None) -> Column:
    """An event's own count; 1 where events have none."""
    return F.coalesce(F.col(count).cast("long"), F.lit(0)) if count else F.lit(1).cast("long")


def flagged_by_type(events: DataFrame, keys: list[str], count: str | None = None) -> DataFrame:
    """(*keys, n): the sum of the events' counts per job, stage and error type (or whatever keys say)."""
    return events.groupBy(*keys).agg(F.sum(count_of(count)).alias("n"))


def exploded_flags(events: DataFrame, types: str, keep: list[str]) -> DataFrame:
    """(*keep, error_type, count) of events that carry a map of error types to counts; null and empty maps give none."""
    return events.select(*keep, F.explode(types).alias("error_type", "count"))


def total_flagged(events: DataFrame, count: str | None = None, flag: str = "flagged") -> DataFrame:
    return events.agg(F.coalesce(F.sum(F.when(F.col(flag), count_of(count)).otherwise(0)), F.lit(0)).alias("errored"))


def job_status(done: DataFrame, chunks: DataFrame, stages: DataFrame, keys: tuple[str, ...] = (), shown: int = 8) -> DataFrame:
    """(*keys, stage, done, missing, missing_ids) of every stage in stages (*keys, stage): chunks (chunk_id) done and not,
    and the ids that are missing, sorted, where they are shown at most. Events of unknown chunks do not count.

    The stages that lack a few chunks (a plan's stages, at most some tens) go along with the chunks as one list."""
    at = [*keys, "stage"]
    known = chunks.select("chunk_id").distinct()
    total = known.agg(F.count("*").alias("chunks"))
    n = done.select(*at, "chunk_id").distinct().join(known, "chunk_id", "left_semi").groupBy(*at).agg(F.count("*").alias("done"))
    out = stages.select(*at).distinct().join(n, at, "left").join(F.broadcast(total)).select(*at, F.coalesce("done", F.lit(0)).alias("done"), "chunks")
    out = out.withColumn("missing", F.col("chunks") - F.col("done"))
    few = out.where((F.col("missing") > 0) & (F.col("missing") <= shown)).select(*at)
    listed = few.agg(F.collect_list(F.struct(*at)).alias("_few"))
    gone = known.join(F.broadcast(listed)).select("chunk_id", F.explode("_few").alias("_at")).select("chunk_id", "_at.*").join(done.select(*at, "chunk_id"), [*at, "chunk_id"], "left_anti")
    ids = gone.groupBy(*at).agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ",").alias("missing_ids"))
    return out.join(ids, at, "left").select(*at, "done", "missing", "missing_ids")


def job_complete(done: DataFrame, last_stage: int, chunk_count: int, job: str = "job") -> DataFrame:
    """(job, complete): whether all chunks have passed the last stage; of jobs that have any there."""
    return done.where(F.col("stage") == last_stage).groupBy(job).agg((F.count_distinct("chunk_id") >= chunk_count).alias("complete"))


def dead_letters(failures: DataFrame, keys: list[str], chunk: str = "chunk_id", most: int = 3) -> DataFrame:
    """(*keys, n): chunks delivered most times without success, each once."""
    tried = failures.groupBy(*keys, chunk).agg(F.count("*").alias("tries"))
    return tried.where(F.col("tries") >= most).groupBy(*keys).agg(F.count("*").alias("n"))


def growth(events: DataFrame, key: str, tick: Column, least: int, count: str | None = None, name: str = "tick") -> DataFrame:
    """(key, tick, n, delta): ticks at which a cumulative counter has grown by least or more since the tick before."""
    per = events.groupBy(key, tick.alias(name)).agg(F.sum(count_of(count)).alias("c"))
    w = Window.partitionBy(key).orderBy(name)
    n = per.select(key, name, F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"))
    return n.withColumn("delta", F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0))).where(F.col("delta") >= least)


# --- scores --------------------------------------------------------------------------------------------------------

#: Size of the quantile sketches, and the rank error that one of them stays below in 99 % of cases (for one quantile).
SKETCH_K = 2048
RANK_ERROR = 2.296 / SKETCH_K**0.9021
#: Values that are looked at one by one on the driver for each rank, once a bracket holds no more.
FEW = 20_000


def values_at(df: DataFrame, value: str, ranks: list[int]) -> dict[int, float]:
    """The values at some ranks (from 0) of a column of doubles without nulls, exactly, however many are equal.

    Each rank has a bracket, first of the lowest and the highest value. A pass counts what lies below and inside each and
    sketches the inside, whose quantiles give the next bracket; one that turns out not to hold its rank is widened. When few
    values are inside, or all there are equal, the rank is found. Passes are few (each leaves about a hundredth), a task
    sends numbers and sketches, and nothing is written or sorted.
    """
    sql = df.sparkSession
    v = df.select(F.col(value).alias("v"))
    bounds = v.agg(F.min("v").alias("a"), F.max("v").alias("b")).first()
    open_ = {r: (bounds.a, bounds.b, None, 8.0) for r in sorted(set(ranks))}  # low, high, the bracket that held it, margin
    found: dict[int, float] = {}
    while open_:
        inside = {r: (F.col("v") >= lo) & (F.col("v") <= hi) for r, (lo, hi, _, _) in open_.items()}
        one = v.agg(*[x for r, (lo, _, _, _) in open_.items() for x in (F.count_if(F.col("v") < lo).alias(f"below{r}"), F.count_if(inside[r]).alias(f"in{r}"), F.kll_sketch_agg_double(F.when(inside[r], F.col("v")), SKETCH_K).alias(f"s{r}"))]).first()
        few, steps = [], {}
        for r, (lo, hi, held, margin) in open_.items():
            below, n = one[f"below{r}"], one[f"in{r}"]
            if not below <= r < below + n:  # the sketch was off by more: back to what held the rank, less boldly
                a, b, sketch, at, size = held
                steps[r] = (a, b, sketch, at, size, 2 * margin)
            elif lo == hi:
                found[r] = lo
            elif n <= FEW:
                few.append((r, lo, hi, below))
            else:
                steps[r] = (lo, hi, one[f"s{r}"], r - below, n, margin)
        if few:
            rows = v.select(F.explode(F.array_compact(F.array(*[F.when(inside[r], F.lit(r)) for r, *_ in few]))).alias("r"), "v").groupBy("r", "v").agg(F.count("*").alias("n")).collect()
            for r, _, _, below in few:
                for x, n in sorted((x.v, x.n) for x in rows if x.r == r):
                    if r < below + n:
                        found[r] = x
                        break
                    below += n
        open_ = {}
        for r, (a, b, sketch, at, size, margin) in steps.items():
            near = [min(1.0, max(0.0, at / max(size - 1, 1) + d * margin * RANK_ERROR)) for d in (-1, 1)]
            lo, hi = sql.range(1).select(F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.array(*map(F.lit, near))).alias("q")).first().q
            lo, hi = (a if near[0] == 0 else lo), (b if near[1] == 1 else hi)
            open_[r] = (lo, hi, (a, b, sketch, at, size), margin)
    return found


def quantiles(df: DataFrame, value: str, probabilities: list[float]) -> dict[float, float | None]:
    """Exact quantiles, linear between neighbours. Nulls are left out; no values give None."""
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    n = rows.count()
    if not n:
        return dict.fromkeys(probabilities)
    places = {p: p * (n - 1) for p in probabilities}
    at = values_at(rows, "v", [min(int(k) + d, n - 1) for k in places.values() for d in (0, 1)])
    return {p: at[int(k)] + (k - int(k)) * (at[min(int(k) + 1, n - 1)] - at[int(k)]) for p, k in places.items()}


def score_sketches(scores: DataFrame, by: list[str], score: str, drop_at: float | None = None) -> DataFrame:
    """(*by, n, dropped, total, squares, low, high, sketch): what a part of a run keeps of its scores, to be stored with it. Parts
    merge, so a run, a route or a window is summed up without its scores being read again."""
    c = F.col(score).cast("double")
    return scores.groupBy(*by).agg(F.count(c).alias("n"), F.count_if(c >= drop_at if drop_at is not None else F.lit(False)).alias("dropped"), F.sum(c).alias("total"), F.sum(c * c).alias("squares"), F.min(c).alias("low"), F.max(c).alias("high"), F.kll_sketch_agg_double(c, SKETCH_K).alias("sketch"))


def merged_sketches(parts: DataFrame, by: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("n", "dropped", "total", "squares")]
    return parts.groupBy(*by).agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_summary(parts: DataFrame, probabilities: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """The parts' columns but the sketch, with mean, std and quantiles (p10 p50 p90 or as asked), whose ranks are off by less
    than RANK_ERROR of n in 99 % of cases. Parts without a score have nulls."""
    mean = F.col("total") / F.nullif(F.col("n"), F.lit(0))
    spread = F.sqrt(F.greatest((F.col("squares") - F.col("n") * mean * mean) / F.nullif(F.col("n") - 1, F.lit(0)), F.lit(0.0)))
    at = {f"p{p * 100:g}": F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for p in probabilities}
    return parts.withColumns({"mean": mean, "std": spread, **at}).drop("sketch", "total", "squares")


def score_summary(scores: DataFrame, score: str, drop_at: float | None = None, probabilities: tuple[float, ...] = (0.1, 0.5, 0.9), digits: int = 6, reason: str | None = None) -> DataFrame:
    """One row: n, dropped (scores of drop_at or more), mean, std, low, high, and p10 p50 p90 or as asked; with reason also
    drops: a map of that column's values to their counts among the rows without a score."""
    r = lambda c: F.round(c, digits)
    c = F.col(score)
    q = quantiles(scores, score, list(probabilities))
    out = scores.agg(F.count(c).alias("n"), F.count_if(c >= drop_at if drop_at is not None else F.lit(False)).alias("dropped"), r(F.avg(c)).alias("mean"), r(F.stddev(c)).alias("std"), F.min(c).alias("low"), F.max(c).alias("high"))
    out = out.withColumns({f"p{p * 100:g}": r(F.lit(v).cast("double")) for p, v in q.items()})
    if reason is None:
        return out
    drops = scores.where(c.isNull() & F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("k"))
    return out.join(F.broadcast(drops.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(reason, "k")))).alias("drops"))))


def bucket_of(score: Column, edges: list[float]) -> Column:
    """The bucket of a score by its lower edges: a-b, the last one up to the last edge and beyond."""
    out = F.lit(None).cast("string")
    for a, b in zip(edges, edges[1:]):
        out = F.coalesce(out, F.when((score < b) | F.lit(b == edges[-1]), f"{a:g}-{b:g}"))
    return F.when(score.isNotNull(), out)


def score_buckets(scores: DataFrame, score: str, edges: list[float]) -> DataFrame:
    return scores.groupBy(bucket_of(F.col(score), edges).alias("bucket")).agg(F.count("*").alias("n"))


def breakdown(scores: DataFrame, by: str, values: list[str], digits: int = 6) -> DataFrame:
    """(by, n, mean_*): rows and means per route, domain or whatever by is."""
    return scores.groupBy(by).agg(F.count("*").alias("n"), *[F.round(F.avg(v), digits).alias(f"mean_{v}") for v in values])


def compare_systems(systems: dict[str, DataFrame], key: str, score: str, base: str, digits: int = 6) -> DataFrame:
    """(key, one column a system, delta_* of each but the base): rows that all systems have."""
    out = None
    for name, df in systems.items():
        one = df.select(key, F.col(score).alias(name))
        out = one if out is None else out.join(one, key)
    return out.withColumns({f"delta_{n}": F.round(F.col(n) - F.col(base), digits) for n in systems if n != base})


def win_tie_loss(pairs: DataFrame, score: str, base: str, lower_is_better: bool = True, digits: int = 6) -> DataFrame:
    """One row: how often score beats, equals and loses to base, and the mean difference."""
    better, worse = (F.col(score) < F.col(base), F.col(score) > F.col(base)) if lower_is_better else (F.col(score) > F.col(base), F.col(score) < F.col(base))
    return pairs.agg(F.count_if(better).alias("wins"), F.count_if(F.col(score) == F.col(base)).alias("ties"), F.count_if(worse).alias("losses"), F.round(F.avg(F.col(score) - F.col(base)), digits).alias("delta"))


def top_changes(pairs: DataFrame, key: str, delta: Column, n: int = 10, worst: bool = True) -> DataFrame:
    """(key, delta): the n largest differences (worst) or the n smallest, ties by key."""
    rows = pairs.select(key, delta.alias("delta")).where("delta is not null")
    return rows.orderBy(F.col("delta").desc() if worst else F.col("delta").asc(), key).limit(n)


# --- plans and events ----------------------------------------------------------------------------------------------

def batch_groups(df: DataFrame, chunk: Column, order: str, size: int) -> DataFrame:
    """chunk and grp: rows of a chunk in order, size to a group; groups never cross chunks."""
    out = df.withColumn("chunk", chunk)
    return out.withColumn("grp", F.floor((F.row_number().over(Window.partitionBy("chunk").orderBy(order)) - 1) / size))


def invalidated(old: DataFrame, new: DataFrame, stage: str = "stage", sig: str = "sig") -> DataFrame:
    """(stage): stages whose signature a new plan changes, adds or drops."""
    both = old.select(F.col(stage), F.col(sig).alias("old")).join(new.select(F.col(stage), F.col(sig).alias("new")), stage, "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(stage)


def dead_outputs(outputs: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys): outputs that no live plan names."""
    return outputs.select(*keys).distinct().join(live.select(*keys), keys, "left_anti")


def current_events(events: DataFrame, plan: DataFrame, keys: list[str], seq: str, floor: str = "floor") -> DataFrame:
    """Events of the plan's own stages and signatures after its floor: stragglers of an old plan and what was counted
    before are left out."""
    return events.join(plan.select(*keys, floor), keys).where(F.col(seq) > F.col(floor)).drop(floor)


def with_ghosts(events: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """events with ghost: true where no object of the key exists."""
    there = objects.select(key).distinct().withColumn("_there", F.lit(True))
    return events.join(there, key, "left").withColumn("ghost", F.col("_there").isNull()).drop("_there")


def rejoin_segments(segments: DataFrame, rows: DataFrame, key: str, kind: str, kinds: dict[str, str]) -> DataFrame:
    """(key, a count for each of kinds: name -> value of kind, segments): the segments of each row that has any, gathered by
    the id they came from."""
    joined = segments.join(rows.select(key), key)
    return joined.groupBy(key).agg(*[F.count_if(F.col(kind) == v).alias(n) for n, v in kinds.items()])


def gather_segments(segments: DataFrame, rows: DataFrame, key: str, kind: str, kinds: dict[str, str], order: str, keep: list[str]) -> DataFrame:
    """rows, each with an array for each of kinds (name -> value of kind): its segments' columns of keep, in order. A row
    without any has empty arrays; segments of no row, or of another kind, are left out. An array holds one record's own
    segments, whose number the record bounds."""
    some = segments.where(F.col(kind).isin(*kinds.values())).groupBy(key).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == v, F.struct(order, F.struct(*keep).alias("_x"))))), lambda s: s["_x"]).alias(n) for n, v in kinds.items()
    ])
    empty = lambda n: F.array().cast(some.schema[n].dataType)
    return rows.join(some, key, "left").withColumns({n: F.coalesce(n, empty(n)) for n in kinds})
