"""SimHash fingerprints and their near-duplicate groups by pivot distance tables (operator 5); groups by verified shingle
similarity (the pipeline)."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import common as C
from sievework.llm.components import connected_components

BITS = 64
PIVOTS = 16
SMALL_BLOCK = 256
#: Fingerprints of a block beyond which it is dealt again.
BLOCK_ROWS = 50_000
HOT_SHARE = 1 / 1000


def counters(text: str | None, shingle: int = 4) -> tuple[np.ndarray, int]:
    """How many of a text's word shingles (fewer words: the whole sequence) have each bit of their hash set, and how many
    shingles there are."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    counts = np.zeros(BITS, np.int64)
    if not words:
        return counts, 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    first, last, digest = starts[:n].tolist(), ends[size - 1 :].tolist(), xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 14):
        h = np.array([digest(line[x:y], 42) for x, y in zip(first[i : i + (1 << 14)], last[i : i + (1 << 14)])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts, n


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of the text's word shingles (no words: 0)."""
    counts, n = counters(text, shingle)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """(id, fp): fp as the signed long with the fingerprint's bits."""

    def run(batches):
        C.drop_caches()
        for batch in batches:
            fp = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp)], ["id", "fp"])

    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(C.NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "id long, fp long")


def block_scheme(nodes: int, distance: int) -> tuple[int, int]:
    """(segments, how many of them agree): distance differing bits leave segments-distance segments equal; enough of them
    that a block of unrelated fingerprints stays small. Exact whatever is chosen."""
    for agree in range(1, 9):
        if nodes >> (BITS * agree // (distance + agree)) <= 16:
            break
    return distance + agree, agree


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of codes of one or more 64-bit words (last axis)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def pivot_table(codes: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each code to fixed reference codes."""
    refs = C.mix(np.arange(1, pivots * codes.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(pivots, -1)
    return np.stack([hamming(codes, r) for r in refs], axis=1)


def block_links(key: np.ndarray, codes: np.ndarray, distance: int, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of links that join all that the pairs within blocks (equal keys) at the distance or less would join.

    By the triangle inequality a pair is within the distance only if no pivot coordinate differs by more: pairs are
    discarded by the largest coordinate difference, then verified. Small blocks compare every pair, in the order of the
    first coordinate; in a large one each code meets only those not reached yet, so a dense group takes one pass or few,
    not its square.
    """
    table = pivot_table(codes, pivots)
    order = np.lexsort((table[:, 0], key))
    key, code, table = key[order], codes[order], table[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(key)))
    big = sizes > SMALL_BLOCK
    block = np.repeat(np.arange(len(starts)), sizes)
    a, b = [], []
    i = np.flatnonzero(~big[block]) if len(block) else block
    for off in range(1, SMALL_BLOCK):
        i = i[i + off < len(key)]
        i = i[(block[i + off] == block[i]) & (table[i + off, 0] - table[i, 0] <= distance)]
        if not len(i):
            break
        k = i
        for c in range(1, pivots):
            k = k[np.abs(table[k + off, c] - table[k, c]) <= distance]
        k = k[hamming(code[k], code[k + off]) <= distance]
        a.append(k), b.append(k + off)
    for s, n in zip(starts[big].tolist(), sizes[big].tolist()):
        left = np.arange(s, s + n)
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                near = (np.abs(table[left] - table[x]) <= distance).all(axis=1)
                near[near] = hamming(code[left[near]], code[x]) <= distance
                hit = left[near]
                left = left[~near]
                queue += hit.tolist()
                a.append(np.full(len(hit), x)), b.append(hit)
    none = np.zeros(0, np.int64)
    return order[np.concatenate([none, *a])], order[np.concatenate([none, *b])]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links but the least of its group, with that least node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    k = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[k], nodes[label[k]]


def pivot_links(nodes: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that join all that pairs of distinct fingerprints (column fp) at the distance or less would join.

    Any two within the distance agree on some segments; each fingerprint goes to one block per choice of segments. A block
    of more than BLOCK_ROWS is dealt again by further segments of the bits that its members do not agree on yet, which
    loses no pair either; so no task holds a value that many fingerprints share. Blocks discard pairs by their pivot
    distance tables, verify the rest and return spanning links.
    """
    spark = nodes.sparkSession
    found = nodes.count()
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def masks(agree: int) -> list[int]:
        segments = distance + agree
        cuts = [BITS * i // segments for i in range(segments + 1)]
        return [sum(((1 << (cuts[s + 1] - cuts[s])) - 1) << cuts[s] for s in chosen) for chosen in combinations(range(segments), agree)]

    def dealt(rows: DataFrame, agree: int, inside: tuple[str, ...] = ()) -> DataFrame:
        bits = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks(agree)])).alias("part", "bits")
        return rows.select("fp", *inside, bits).select("fp", F.xxhash64(*inside, F.lit(agree), "part", "bits").alias("key"))

    agree = block_scheme(found, distance)[1]
    blocks = dealt(nodes.select("fp"), agree)
    sizes = blocks.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS)
    sizes = C.settled(sizes)
    if sizes.head(1):
        # a block's members agree on a part of the bits: with two segments more, they are told apart by the others
        large = dealt(blocks.join(F.broadcast(sizes.select(F.col("key").alias("_large"))), F.col("key") == F.col("_large")).select("fp", F.col("key").alias("of")), agree + 2, ("of",))
        blocks = blocks.join(F.broadcast(sizes.select("key")), "key", "left_anti").select("fp", "key").unionByName(large.select("fp", "key"))
    buckets = max(C.partitions(spark), found * len(masks(agree)) // (1 << 20) + 1)
    blocks = blocks.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))

    def join(t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_numpy()
        a, b = block_links(t.column("key").to_numpy(), fp.view(np.uint64)[:, None], distance)
        a, b = forest(fp[a], fp[b])
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return blocks.groupBy("bucket").applyInArrow(join, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """(id, fp, component): near-duplicate groups of documents whose fingerprints link at distance differing bits or fewer.

    Equal fingerprints are one node (a group of exact copies costs one row), so only different fingerprints are compared,
    by pivot_links. component is the smallest id reachable. Null or wordless texts have fingerprint 0 and link like any
    other. Null ids sort last: a group without any id has a null component. Repeated rows give repeated results. Other
    columns are not read. An empty table gives no rows.
    """
    marked = C.checkpointed(fingerprints(docs, id_col, text_col, shingle))
    nodes = C.checkpointed(marked.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")))
    parts = connected_components(C.checkpointed(pivot_links(nodes, distance))).withColumnRenamed("node", "fp")
    leads = parts.join(nodes, "fp").groupBy("component").agg(F.min("low").alias("lead"))
    of_node = nodes.join(parts.join(leads, "component").select("fp", "lead"), "fp", "left").select("fp", "n", F.coalesce("lead", "low").alias("component"))
    # fingerprints of very many rows: at most 1 / HOT_SHARE of them, so they go along with every task
    rows = nodes.agg(F.sum("n")).first()[0] or 0
    hot = of_node.where(F.col("n") > max(HOT_SHARE * rows, 1000)).select("fp", "component")
    rest = marked.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(of_node.select("fp", "component"), "fp")
    out = rest.unionByName(marked.join(F.broadcast(hot), "fp").select(*rest.columns))
    return out.select(C.public_id("id").alias(id_col), "fp", C.public_id("component").alias("component"))


#: Min-hashes of a text; BANDS of ROWS of them find candidates, one bit of each is the sketch that thins them out.
HASHES, BANDS, ROWS = 128, 20, 6
#: Shingles of the texts that one task compares at a time, and texts of a block up to which their sketches are compared first.
SLICE_SHINGLES, LOOK_ROWS = 1 << 20, 4096
SALTS = 64


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles (fewer words: the whole sequence; none: empty)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    lines = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}
    return np.unique(np.fromiter((digest(x, 42) for x in lines), np.uint64, len(lines)))


def set_fingerprint(shingles: np.ndarray) -> int:
    """64-bit SimHash of a set of shingle hashes (empty: 0)."""
    ones = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.uint64)[0])


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of HASHES hash functions over a set; two sets agree on each as often as their Jaccard."""
    seeds = C.mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flip, odd = seeds[:HASHES], seeds[HASHES:] | np.uint64(1)
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        out = np.minimum(out, ((shingles[i : i + 1024, None] ^ flip) * odd).min(axis=0))
    return C.mix(out)


def band_keys(least: np.ndarray) -> np.ndarray:
    """Per row of min-hashes the keys of its bands."""
    part = least[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), part.shape[:2]).copy()
    for r in range(ROWS):
        key = C.mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key


def sketches_of(least: np.ndarray) -> np.ndarray:
    """Per row of min-hashes one bit of each, in 64-bit words."""
    return np.packbits((least & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def sketch_limit(similarity: float) -> int:
    """Differing bits of a sketch that a pair of the Jaccard similarity has, and four standard deviations more: a candidate
    is verified afterwards, so the limit only has to be wide."""
    apart = (1 - similarity) / 2
    return int(np.ceil(HASHES * apart + 4 * (HASHES * apart * (1 - apart)) ** 0.5))


def stars(key: np.ndarray, node: np.ndarray, code: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers (member, leader) of each row with its block's leader, as far as their sketches are within the limit, and
    the leaders. The leader of a block (equal keys) is the text nearest to what most of the block's sketches have in each
    bit: of edits of one text, that text or the one like it most."""
    order = np.lexsort((node, key))
    k = key[order]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(k)))
    alone = order[starts[sizes == 1]]
    order = order[np.repeat(sizes > 1, sizes)]  # most blocks are one row
    sizes = sizes[sizes > 1]
    if not len(sizes):
        return order, order, alone
    starts = np.cumsum(sizes) - sizes
    block = np.repeat(np.arange(len(starts)), sizes)
    code_, centre = code[order], np.empty((len(starts), code.shape[1]), np.uint64)
    for word in range(code.shape[1]):
        bits = np.unpackbits(np.ascontiguousarray(code_[:, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        most = np.add.reduceat(bits, starts, axis=0, dtype=np.int32) * 2 > sizes[:, None]
        centre[:, word] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    far = hamming(code_, centre[block])
    lead = order[np.lexsort((node[order], far, block))[starts]]
    use = (node[order] != node[lead][block]) & (hamming(code_, code[lead][block]) <= limit)
    return order[use], lead[block][use], np.concatenate([alone, lead])


def open_rows(key: np.ndarray, node: np.ndarray, code: np.ndarray, comp: np.ndarray, limit: int) -> np.ndarray:
    """Row numbers of blocks' members that may link to a member of another component: their sketches are within the limit.
    Of a large block all rows count if it has two components."""
    order = np.lexsort((node, comp, key))
    k, c, code = key[order], comp[order], code[order]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, int)
    ends = np.append(starts[1:], len(k))
    use = np.zeros(len(k), bool)
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        if c[s] == c[e - 1]:
            continue
        if e - s > LOOK_ROWS:
            use[s:e] = True
            continue
        for x in range(s, e):
            near = (c[s:e] != c[x]) & (hamming(code[s:e], code[x]) <= limit)
            use[x] |= near.any()
    return order[use]


def set_links(sets: list[np.ndarray], comp: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (row numbers) that join all that pairs of sets of the Jaccard similarity or more would join, given what comp
    joins already. One row meets all others at once, by the places of its shingles among theirs; rows of the largest
    component need not be asked."""
    n, sizes = len(sets), np.array([len(x) for x in sets])
    values = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = np.argsort(values, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    new = np.append(True, values[order][1:] != values[order][:-1]) if len(values) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(values)))
    group = np.empty(len(values), np.int64)
    group[order] = np.cumsum(new) - 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    label = np.unique(comp, return_inverse=True)[1]
    most = np.bincount(label).argmax()
    a, b = [], []
    for x in np.flatnonzero(label != most).tolist():
        g = group[at[x] : at[x + 1]]
        total = counts[g]
        place = np.repeat(starts[g] - np.cumsum(total) + total, total) + np.arange(total.sum())
        shared = np.bincount(owner[place], minlength=n)
        near = np.flatnonzero((shared >= similarity * (sizes + sizes[x] - shared) - 1e-9) & (label != label[x]))
        for y in near.tolist():
            if label[y] != label[x]:
                a.append(x), b.append(y)
                label[label == label[y]] = label[x]
    return np.array(a, np.int64), np.array(b, np.int64)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets (node, shingles) have the exact Jaccard similarity or more. A set goes along once per
    pair and not by pairs' keys alone: the pairs of one representative are dealt over SALTS parts."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    left = salted.select("a", "salt").distinct().join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = salted.join(left, ["a", "salt"]).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, id_col: str, text_col: str, shingle: int = 5, similarity: float = 0.8, distance: int = 4) -> DataFrame:
    """(id, component): groups of documents linked by an exact Jaccard similarity of distinct word shingles.

    Equal sets of shingles are one node. Fingerprints, bands and sketches only name candidates: every link is verified on
    the shingle sets (as 64-bit hashes) before it joins anything. First the links of the SimHash operator (pivot_links over
    fingerprints of the sets) and, for pairs whose fingerprints are farther apart, each node with the leader of its blocks
    of equal min-hash bands, chosen in each Arrow batch before the exchange, so a block with a third of all rows is a row a
    batch; of its leaders a node meets the two nearest, as this step only saves work for the next. Then what is still apart in a block and may be alike meets in tasks that hold the members' sets and give back
    spanning links. A block with much text is dealt to slices: members of its main component to one each, the others to
    all, so every pair that is still apart meets.
    """
    spark = docs.sparkSession
    limit = sketch_limit(similarity)
    fields = "id long, tag long, node long, fp long, size int, sketch binary, bands binary"

    def signatures(batches):
        C.drop_caches()
        for batch in batches:
            got = [shingle_set(x, shingle) for x in batch.column("text").to_pylist()]
            least = np.array([min_hashes(x) for x in got], np.uint64).reshape(-1, HASHES)
            node = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in got], np.uint64).view(np.int64)
            fp = np.array([set_fingerprint(x) for x in got], np.uint64).view(np.int64)
            pack = lambda a: pa.array([x.tobytes() for x in a], pa.binary())
            size = pa.array([len(x) for x in got], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tag"), pa.array(node), pa.array(fp), size, pack(sketches_of(least)), pack(band_keys(least))], ["id", "tag", "node", "fp", "size", "sketch", "bands"])
        C.give_back()

    plain = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(C.NO_ID)).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).withColumn("tag", F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")))
    with C.text_batches(spark):
        marked = C.checkpointed(plain.mapInArrow(signatures, fields))
    nodes = marked.groupBy("node").agg(F.min(F.struct("id", "tag")).alias("low"), *[F.min(c).alias(c) for c in ("fp", "size", "sketch", "bands")])
    nodes = C.settled(nodes.select("node", "low.id", "low.tag", "fp", "size", "sketch", "bands"))
    buckets = max(C.partitions(spark), nodes.count() * BANDS // (1 << 18) + 1)

    def arrays(batch):
        node = batch.column("node").to_numpy()
        code = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(len(node), -1)
        key = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.uint64)
        who = np.repeat(np.arange(len(node)), BANDS)
        return key, node, code, who

    def by_bucket(key, columns):
        """Packed rows, one a bucket."""
        home = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        full, start = np.unique(home[order], return_index=True)
        cut = np.split(order, start[1:]) if len(full) else []
        return {"bucket": pa.array(full, pa.int32())} | {c: pa.array([v[x].tobytes() for x in cut], pa.binary()) for c, v in ({"keys": key} | columns).items()}

    def unpacked(t):
        join = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
        node = join("nodes", np.int64)
        return join("keys", np.uint64), node, join("codes", np.uint64).reshape(len(node), -1)

    def nearest(a, b, node, code):
        """Of each member the leader whose sketch is nearest: nodes a and b, and the distance."""
        far = hamming(code[a], code[b])
        order = np.lexsort((node[b], far, node[a]))
        order = order[np.append(True, node[a][order][1:] != node[a][order][:-1])] if len(order) else order
        return {"a": node[a][order], "b": node[b][order], "far": far[order].astype(np.int64)}

    def meet(batches):
        for batch in batches:
            if batch.num_rows:
                key, node, code, who = arrays(batch)
                a, b, lead = stars(key, node[who], code[who], limit)
                packed = by_bucket(key[lead], {"nodes": node[who[lead]], "codes": code[who[lead]]})
                empty = pa.array([b""] * len(packed["bucket"]), pa.binary())
                yield pa.RecordBatch.from_pydict(packed | {c: empty for c in ("a", "b", "far")})
                one = {"bucket": pa.array([-1], pa.int32())} | {c: pa.array([b""]) for c in ("keys", "nodes", "codes")}
                yield pa.RecordBatch.from_pydict(one | {c: pa.array([v.tobytes()]) for c, v in nearest(a, b, node[who], code[who]).items()})

    def leaders(t: pa.Table) -> pa.Table:
        key, node, code = unpacked(t)
        a, b, _ = stars(key, node, code, limit)
        return pa.table({c: pa.array(v) for c, v in nearest(a, b, node, code).items()})

    def flat(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({c: pa.array(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64)) for c in ("a", "b", "far")})

    def first_candidates() -> DataFrame:
        met = C.settled(nodes.select("node", "sketch", "bands").mapInArrow(meet, "bucket int, keys binary, nodes binary, codes binary, a binary, b binary, far binary"))
        best = lambda x: x.groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
        near = best(met.where("bucket = -1").select("a", "b", "far").mapInArrow(flat, "a long, b long, far long"))
        far = best(met.where("bucket >= 0").groupBy("bucket").applyInArrow(leaders, "a long, b long, far long"))
        of_fp = nodes.groupBy("fp").agg(F.min("node").alias("least"))
        same = nodes.join(of_fp, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
        ends = [of_fp.select(F.col("fp").alias(x), F.col("least").alias(f"of_{x}")) for x in "ab"]
        linked = pivot_links(of_fp.select("fp"), distance).join(ends[0], "a").join(ends[1], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        every = near.unionByName(far).unionByName(same).unionByName(linked).where("a <> b")
        return C.settled(every.distinct())

    def shingles(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([shingle_set(x, shingle).tobytes() for x in batch.column("text").to_pylist()], pa.binary())], ["node", "shingles"])

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes asked for, from one text of each; a text of many rows counts once."""
        at = wanted.distinct().join(nodes.select("node", "id", "tag"), "node")
        texts = plain.join(at, ["id", "tag"]).dropDuplicates(["node"])
        return texts.select("node", "text").mapInArrow(shingles, "node long, shingles binary")

    pairs = first_candidates()
    with C.text_batches(spark):
        sets = C.settled(sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b"))))
        links = C.settled(verified(pairs, sets, similarity))
    # what the links join within two steps, from members to leaders and on to theirs: the rest is found below
    lead = links.groupBy("a").agg(F.min("b").alias("b"))
    lead = lead.join(lead.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left").select(F.col("a").alias("node"), F.coalesce("c", "b").alias("component"))
    joined = nodes.join(lead, "node", "left").withColumn("comp", F.coalesce("component", "node"))

    def scatter(batches):
        for batch in batches:
            if batch.num_rows:
                key, node, code, who = arrays(batch)
                comp, size = batch.column("comp").to_numpy(), batch.column("size").to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_pydict(by_bucket(key, {"nodes": node[who], "codes": code[who], "comps": comp[who], "sizes": size[who]}))

    def still_open(t: pa.Table) -> pa.Table:
        key, node, code = unpacked(t)
        comp, size = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.int64) for c in ("comps", "sizes"))
        x = open_rows(key, node, code, comp, limit)
        return pa.table({"key": pa.array(key[x].view(np.int64)), "node": pa.array(node[x]), "comp": pa.array(comp[x]), "size": pa.array(size[x])})

    scattered = joined.select("node", "comp", "size", "sketch", "bands").mapInArrow(scatter, "bucket int, keys binary, nodes binary, codes binary, comps binary, sizes binary")
    members = C.settled(scattered.groupBy("bucket").applyInArrow(still_open, "key long, node long, comp long, size long"))
    weights = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("w")).groupBy("key").agg(F.sum("w").alias("w"), F.max_by("comp", F.struct("n", "comp")).alias("main"))
    large = weights.where(F.col("w") > SLICE_SHINGLES).select("key", "main", (F.col("w") / SLICE_SHINGLES + 1).cast("int").alias("slices"))
    dealt = members.join(large, "key", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    slices = F.when((F.col("slices") == 1) | (F.col("comp") == F.col("main")), own).otherwise(F.sequence(F.lit(0), F.col("slices") - 1))
    dealt = dealt.select("key", "node", "comp", F.explode(slices).alias("slice"))
    tasks = max(C.partitions(spark), (members.agg(F.sum("size")).first()[0] or 0) // (4 * SLICE_SHINGLES) + 1)
    dealt = dealt.join(sets_of(members.select("node")), "node").withColumn("task", F.pmod(F.xxhash64("key", "slice"), F.lit(tasks)))

    def compare(t: pa.Table) -> pa.Table:
        block = np.stack([t.column("key").to_numpy(), t.column("slice").to_numpy()], axis=1)
        of = np.unique(block, axis=0, return_inverse=True)[1].ravel()
        node, comp, found = t.column("node").to_numpy(), t.column("comp").to_numpy(), t.column("shingles").to_pylist()
        order = np.argsort(of, kind="stable")
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            x, y = set_links([np.frombuffer(found[i], np.uint64) for i in rows.tolist()], comp[rows], similarity)
            a.append(node[rows[x]]), b.append(node[rows[y]])
        return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    more = dealt.groupBy("task").applyInArrow(compare, "a long, b long")
    with C.text_batches(spark):
        found = C.settled(links.union(more))
    parts = connected_components(found)
    leads = parts.join(nodes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("lead"))
    of_node = nodes.select("node", F.col("id").alias("low")).join(parts.join(leads, "component").select("node", "lead"), "node", "left").select("node", F.coalesce("lead", "low").alias("component"))
    return marked.select("id", "node").join(of_node, "node").select(C.public_id("id").alias(id_col), C.public_id("component").alias("component"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs, one of each near-duplicate group (similar_groups): that of the smallest id. A row without an id
    yields to one with an id; rows without ids and with one text count as repeated rows, and of repeated rows (id and text)
    one stays. Texts without words are one group. An empty table gives no rows; columns may have any name."""
    text = F.col(f"`{text_col}`").cast("string")
    stand_in = F.lit(C.NO_ID - 1) - F.abs(F.xxhash64(text).bitwiseAND(F.lit((1 << 61) - 1)))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), stand_in).alias("near_id"), F.xxhash64(text).alias("near_text"))
    lead = similar_groups(docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), stand_in).alias("near_id"), text.alias("near_body")), "near_id", "near_body", shingle, similarity)
    kept = named.join(lead.where("near_id = component").select("near_id").distinct(), "near_id", "left_semi")
    keys = ["near_id", "near_text"]
    again = C.settled(named.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys))
    if again.head(1):
        once, more = kept.join(again, keys, "left_anti"), kept.join(again, keys, "left_semi")
        kept = once.unionByName(more.groupBy(*keys).agg(F.first("row").alias("row")).select(*once.columns))
    return kept.select(*C.out_of_one(docs.columns))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
