"""Exact top-k search over binary codes by incremental multi-index hashing (operator 8)."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import common as C

BITS = 64
#: Candidates that a block of queries may expand to at a time.
EXPAND = 1 << 21


def binary_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, code): bit i of the code is set where element i is above zero. Null vectors give no code; vectors of fewer than 64
    elements leave the other bits 0, and one of more is an error: none of its elements may be passed over."""
    signed = lambda i: (1 << i) - (1 << 64 if i == 63 else 0)
    bits = [F.when(F.get(vector_col, F.lit(i)) > 0, F.lit(signed(i)).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    code = reduce(lambda a, b: a.bitwiseOR(b), bits)
    code = F.when(F.size(vector_col) > BITS, F.raise_error(F.lit(f"a vector has more than {BITS} elements")).cast("long")).otherwise(code)
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), code.alias("code"))


class MultiIndex:
    """Tables of the codes by each of their segments; the radius of a search grows until the k nearest are proven."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, copies: int | None = None):
        """Repeated rows count once. copies: of each code, only so many rows of the least ids; k + 1 lose nothing in a search
        for k."""
        order = np.lexsort((ids, codes))
        if len(order):
            order = order[np.append(True, (np.diff(codes[order]) != 0) | (np.diff(ids[order]) != 0))]
        if copies and len(order):
            start = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
            order = order[np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order)))) < copies]
        self.ids, self.codes = ids[order], codes[order]
        # segments of about log2(n) bits, so that a lookup meets a code or so; at most 16 bits, so that a table stays small
        width = int(np.clip(np.log2(max(2, len(ids))), 4, 16))
        self.count = -(-BITS // width)
        cuts = [BITS * i // self.count for i in range(self.count + 1)]
        self.widths = [b - a for a, b in zip(cuts, cuts[1:])]
        self.shifts = [np.uint64(a) for a in cuts[:-1]]
        self.tables = []
        for w, s in zip(self.widths, self.shifts):
            part = self._part(self.codes, w, s)
            by = np.argsort(part, kind="stable")
            self.tables.append((by, np.searchsorted(part[by], np.arange((1 << w) + 1))))

    @staticmethod
    def _part(codes, width, shift):
        return ((codes >> shift) & np.uint64((1 << width) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the (distances, ids) of its k nearest, by distance and then id, but not the row of its own id."""
        n = len(queries)
        best_d = np.full((n, k), BITS + 1, np.int16)
        best_i = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        live = np.arange(n)
        for radius in range(max(self.widths) + 1):
            if not len(live):
                break
            for j, (w, s) in enumerate(zip(self.widths, self.shifts)):
                if radius > w:
                    continue
                masks = np.array([sum(1 << b for b in c) for c in combinations(range(w), radius)], np.int64)
                by, starts = self.tables[j]
                block = max(1, EXPAND // (4 * len(masks)))
                at = 0
                while at < len(live):
                    q = live[at : at + block]
                    probe = self._part(queries[q], w, s)[:, None] ^ masks[None, :]
                    sizes = starts[probe + 1] - starts[probe]
                    most = np.cumsum(sizes.sum(axis=1))
                    fit = max(1, int(np.searchsorted(most, EXPAND, side="right")))
                    q, probe, sizes = q[:fit], probe[:fit].ravel(), sizes[:fit].ravel()
                    at += fit
                    which = np.repeat(np.repeat(np.arange(len(q)), len(masks)), sizes)
                    row = by[np.repeat(starts[probe] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                    self._merge(best_d, best_i, q, which, row, queries, own, k)
            # codes that no table has shown yet differ by more than radius in every segment
            proven = self.count * (radius + 1) - 1
            live = live[best_d[live, k - 1] > proven]
        return [(d[d <= BITS], i[d <= BITS]) for d, i in zip(best_d, best_i)]

    def _merge(self, best_d, best_i, q, which, row, queries, own, k):
        merge(self.codes, self.ids, best_d, best_i, q, which, row, queries, own, k)


def merge(codes, ids, best_d, best_i, q, which, row, queries, own, k, bound=None):
    """Put candidates (row of codes for number which of q) among the best of their queries, but for the query's own row and
    those beyond its bound."""
    d = np.bitwise_count(codes[row] ^ queries[q[which]]).astype(np.int16)
    ids = ids[row]
    use = (d <= best_d[q[which], k - 1]) & (ids != own[q[which]])
    use = use if bound is None else use & (d <= bound[q[which]])
    which, d, ids = which[use], d[use], ids[use]
    if not len(which):
        return
    hit = np.unique(which)
    which = np.concatenate([which, np.repeat(hit, k)])
    d = np.concatenate([d, best_d[q[hit]].ravel()])
    ids = np.concatenate([ids, best_i[q[hit]].ravel()])
    order = np.lexsort((ids, d, which))
    which, d, ids = which[order], d[order], ids[order]
    new = np.append(True, (which[1:] != which[:-1]) | (ids[1:] != ids[:-1]) | (d[1:] != d[:-1])) | (d > BITS)
    which, d, ids = which[new], d[new], ids[new]
    start = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    rank = np.arange(len(which)) - np.repeat(start, np.diff(np.append(start, len(which))))
    top = rank < k
    best_d[q[which[top]], rank[top]] = d[top]
    best_i[q[which[top]], rank[top]] = ids[top]


def part_search(codes, ids, shift: int, low_bits: int, queries, own, far, bound, radii, k: int):
    """In one part of one segment's table: per query the best (distances, ids) among the rows whose segment value differs
    from the query's in one of radii bits. far: bits by which the part's own leading bits differ from the query's; the
    rest of a radius is sought in the segment's other bits."""
    part = lambda x: ((x >> np.uint64(shift)) & np.uint64((1 << low_bits) - 1)).astype(np.int64)
    low = part(codes)
    by = np.argsort(low, kind="stable")
    starts = np.searchsorted(low[by], np.arange((1 << low_bits) + 1))
    best_d = np.full((len(queries), k), BITS + 1, np.int16)
    best_i = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
    for radius in radii:
        for f in np.unique(far).tolist():
            live = np.flatnonzero(far == f)
            if not 0 <= radius - f <= low_bits:
                continue
            masks = np.array([sum(1 << b for b in c) for c in combinations(range(low_bits), radius - f)], np.int64)
            step, at = max(1, EXPAND // (4 * len(masks))), 0
            while at < len(live):
                q = live[at : at + step]
                probe = part(queries[q])[:, None] ^ masks[None, :]
                sizes = starts[probe + 1] - starts[probe]
                fit = max(1, int(np.searchsorted(np.cumsum(sizes.sum(axis=1)), EXPAND, side="right")))
                q, probe, sizes = q[:fit], probe[:fit].ravel(), sizes[:fit].ravel()
                at += fit
                which = np.repeat(np.repeat(np.arange(len(q)), len(masks)), sizes)
                row = by[np.repeat(starts[probe] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                merge(codes, ids, best_d, best_i, q, which, row, queries, own, k, bound)
    return best_d, best_i


#: Rows of a part of a table; the leading bits of a segment tell parts apart.
PART_ROWS = 200_000
#: Masks that are written out in a plan; a round that reaches more parts goes to nearly all.
MASKS = 4096
#: The search radii of a segment, as many at a time as one round covers.
ROUNDS = ((0, 1), (2, 3), (4, 5), (6, 16))


def nearest_codes(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows of vectors nearest to each row of queries by Hamming distance of
    their sign codes, ties by smaller id; a row is not its own neighbour. Exact, whatever the codes.

    Each code stands in one table a segment (about log2 of the rows wide, 16 bits at most). A table is cut to parts by the
    leading bits of its segment, and a query goes only to the parts that its radius reaches: those whose leading bits
    differ from its own in no more bits. Radii grow by rounds; a code that no table has shown within a radius differs by
    more in every segment, so a query whose k-th distance is below that sum is proven and leaves, and later rounds carry
    the others with their k-th distance as a bound. Of equal codes only the k + 1 least ids can be among any k nearest, so
    a large group of copies costs no more. Null ids or vectors are neither rows nor queries; of repeated rows (equal id
    and code) one counts; an empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("distance", "neighbor_id"))
    first = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    rows = C.checkpointed(binary_codes(vectors, id_col, vector_col).distinct().withColumn("r", first).where(F.col("r") <= k + 1).select("id", "code"))
    asked = C.checkpointed(binary_codes(queries, id_col, vector_col).distinct().select(F.col("id").alias("query_id"), "code"))
    n = rows.count()
    width = int(np.clip(np.log2(max(2, n)), 4, 16))
    count = -(-BITS // width)
    cuts = [BITS * i // count for i in range(count + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:])]
    lead = min(*widths, max(0, int(np.ceil(np.log2(max(n, 1) / part_rows)))))
    top = lambda j: F.shiftrightunsigned("code", cuts[j + 1] - lead).bitwiseAND((1 << lead) - 1).cast("int") if lead else F.lit(0)
    tops = F.posexplode(F.array(*map(top, range(count)))).alias("segment", "top")
    # a part's queries, split over as many blocks as give every core work
    blocks = max(1, C.partitions(spark) // (count << lead))
    tables = rows.select("id", "code", tops).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["segment", "top", "block"]

    def search(radii):
        def run(t: pa.Table, ask: pa.Table) -> pa.Table:
            kinds = {"query_id": pa.int64(), "code": pa.int64(), "neighbor_id": pa.int64(), "distance": pa.int64()}
            if not t.num_rows or not ask.num_rows:
                return pa.table({c: pa.array([], kind) for c, kind in kinds.items()})
            read = lambda x, c: x.column(c).to_numpy()
            j, own, code = ask.column("segment")[0].as_py(), read(ask, "query_id"), read(ask, "code")
            d, i = part_search(read(t, "code").view(np.uint64), read(t, "id"), cuts[j], widths[j] - lead, code.view(np.uint64), own, read(ask, "far"), read(ask, "bound"), radii, k)
            q, r = np.nonzero(d <= BITS)
            return pa.table({c: pa.array(v, kinds[c]) for c, v in {"query_id": own[q], "code": code[q], "neighbor_id": i[q, r], "distance": d[q, r].astype(np.int64)}.items()})

        return run

    best, live = None, asked.withColumn("bound", F.lit(BITS + 1).cast("long"))
    for low, high in ROUNDS:
        high = min(high, max(widths))
        # the parts in reach, by what their leading bits differ in; no other part is a row at any time
        masks = [m for m in range(1 << lead) if m.bit_count() <= high]
        mask = F.explode(F.array(*map(F.lit, masks)) if len(masks) <= MASKS else F.sequence(F.lit(0), F.lit((1 << lead) - 1))).alias("mask")
        visits = live.select("query_id", "code", "bound", tops).select("*", mask).withColumns({"far": F.bit_count("mask"), "top": F.col("top").bitwiseXOR(F.col("mask"))})
        visits = visits.where(F.col("far") <= high).drop("mask").withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        found = tables.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(search(range(low, high + 1)), "query_id long, code long, neighbor_id long, distance long")
        found = (found if best is None else best.unionByName(found)).distinct()
        best = C.checkpointed(found.withColumn("r", place("query_id", "code")).where(F.col("r") <= k).drop("r"))
        if high == max(widths):
            break
        kth = best.groupBy("query_id", "code").agg(F.count("*").alias("n"), F.max("distance").alias("d"))
        rest = asked.join(kth, ["query_id", "code"], "left").where(F.col("n").isNull() | (F.col("n") < k) | (F.col("d") > count * (high + 1) - 1))
        live = C.checkpointed(rest.select("query_id", "code", F.when(F.col("n") == k, F.col("d")).otherwise(F.lit(BITS + 1)).cast("long").alias("bound")))
        if not live.head(1):
            break
    out = best.select("query_id", "neighbor_id", "distance").distinct().withColumn("rank", place("query_id").cast("long")).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "neighbor_id", "distance")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_codes(vectors, vectors.where("vec_id % 20 = 0"))


OP8_SQL = """
WITH b AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
c AS (SELECT vec_id, sum(CASE WHEN x > 0 THEN (1::HUGEINT << i::INT) ELSE 0 END)::UBIGINT AS code FROM b WHERE i < 64 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, bit_count(xor(q.code, r.code))::BIGINT AS distance FROM c q JOIN c r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::BIGINT AS rank, neighbor_id, distance FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) <= 10
"""
