"""Benchmark decontamination with an FM-index per shard of the training texts (operator 7)."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm import common as C

#: Bytes of a word (after A-Z are lower-cased): digits, letters, and all of every character beyond ASCII.
_SPLIT = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
SHARD_WORDS = 1 << 20
SAMPLE = 8


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


class _Ids(dict):
    def __missing__(self, word):
        return 0


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self) + 1
        return n


class Phrases:
    """The windows of benchmark items over one array of word numbers (1 and up; 0 stands for any other word).

    sizes: per window length the places of its distinct windows in the array, and of each window the items that have it
    (where its run of owners starts, and the owners). Equal windows are found by two 64-bit hashes; no window is an object
    of its own, so millions of windows are some arrays."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        numbers = _Numbers()
        split = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in (words(t) for _, t in items)]
        self.ids, self.items = _Ids(numbers), [k for k, _ in items]
        self.seq = np.concatenate([np.zeros(0, np.int32), *split])
        n = np.array([len(x) for x in split], np.int64)
        first = np.cumsum(n) - n
        mixed = C.mix(self.seq.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        self.sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(int(x), window) for x in n if x}):
            own = np.flatnonzero(n >= window if size == window else n == size)
            count = n[own] - size + 1
            owner = np.repeat(own, count)
            start = np.repeat(first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            a, b = C.windows(mixed, size)[start], C.windows(mixed, size, 0xD6E8FEB86659FD93)[start]
            order = np.lexsort((owner, b, a))
            a, b, start, owner = a[order], b[order], start[order], owner[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            keep = new | np.append(True, owner[1:] != owner[:-1])
            new, start, owner = new[keep], start[keep], owner[keep]
            self.sizes[size] = start[new], np.append(np.flatnonzero(new), len(owner)), owner.astype(np.int32)
        self.shortest = min(self.sizes, default=0)


class WaveletTree:
    """Ranks over a sequence of numbers below 2**bits: one bit vector a level, each with its running counts of ones."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place, relative to the start of the symbol's run in the last level."""
        low = np.zeros_like(at)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = ones[at], ones[low]
            at, low = np.where(one, zeros + a, at - a), np.where(one, zeros + b, low - b)
        return at - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each stands before its place."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            one = (ones[at + 1] - ones[at]).astype(bool)
            a, b = ones[at], ones[low]
            at, low = np.where(one, zeros + a, at - a), np.where(one, zeros + b, low - b)
            symbol = symbol * 2 + one
        return symbol, at - low


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By prefix doubling; only suffixes that still tie are sorted again."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    s = seq[order]
    head = np.append(True, s[1:] != s[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    rank[n] = -1
    step = 1
    while not head.all():
        run = np.cumsum(head) - 1
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        o = order[tied]
        nxt = rank[np.minimum(o + step, n)]
        by = np.lexsort((nxt, run[tied]))
        order[tied] = o = o[by]
        nxt, r = nxt[by], run[tied]
        head[tied[1:]] |= (r[1:] == r[:-1]) & (nxt[1:] != nxt[:-1])
        rank[order[tied]] = np.maximum.accumulate(np.where(head, np.arange(n), 0))[tied]
        step *= 2
    return order


class FMIndex:
    """Backward search and locate over a sequence of numbers; 0 breaks every phrase."""

    def __init__(self, seq: np.ndarray, symbols: int):
        seq = np.append(seq.astype(np.int32) + 1, np.int32(0))  # one end mark, less than any number
        order = suffix_array(seq)
        self.tree = WaveletTree(seq[order - 1], int(symbols + 1).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols + 2))])
        self.marked = np.concatenate([[0], np.cumsum(order % SAMPLE == 0)])
        self.places = order[order % SAMPLE == 0]
        self.n = len(seq)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of the phrases (rows of one length); empty where a phrase does not occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            c = phrases[live, k].astype(np.int64) + 1
            low[live], high[live] = self.first[c] + self.tree.rank(c, low[live]), self.first[c] + self.tree.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffixes, walking back to the nearest sampled one."""
        at, out, steps, live = rows.astype(np.int64), np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(live):
            done = self.marked[at + 1] > self.marked[at]
            out[live[done]] = self.places[self.marked[at[done]]] + steps
            live, at = live[~done], at[~done]
            c, r = self.tree.access(at)
            at = self.first[c] + r
            steps += 1
        return out


#: Windows that are searched for at a time.
SEARCHED = 1 << 18


def shard_hits(texts: list, phrases: Phrases) -> tuple[list[int], list[np.ndarray], list[set]]:
    """Of each text of a shard: its words, which of them an occurrence of a window covers, the items that occur.

    The shard's texts, as benchmark word numbers, are indexed once. A word that no window holds is 0; what stands
    between two zeros and is shorter than any window is left out of the index: no backward search could reach it. Windows
    with a word that the index lacks are not searched for.
    """
    split = [np.fromiter(map(phrases.ids.__getitem__, w), np.int32, len(w)) for w in map(words, texts)]
    sizes = [len(x) for x in split]
    hits, items = [np.zeros(n, bool) for n in sizes], [set() for _ in sizes]
    if not phrases.sizes:
        return sizes, hits, items
    zero = np.zeros(1, np.int32)
    seq = np.concatenate([zero, *(y for x in split for y in (x, zero))])
    doc = np.concatenate([[0], *(np.full(n + 1, k) for k, n in enumerate(sizes))])
    start = np.concatenate([[1], 1 + np.cumsum(np.array(sizes, np.int64) + 1)])
    breaks = np.flatnonzero(seq == 0)
    run = np.diff(np.append(breaks, len(seq))) - 1
    keep = np.repeat(run >= phrases.shortest, run + 1)
    place = np.flatnonzero(keep)
    if not len(place):
        return sizes, hits, items
    index = FMIndex(seq[place], len(phrases.ids))
    present = np.zeros(len(phrases.ids) + 1, bool)
    present[seq[place]] = True
    absent = np.concatenate([[0], np.cumsum(~present[phrases.seq])])
    depth = np.zeros(len(seq) + 1, np.int32)
    for size, (first, runs, owners) in phrases.sizes.items():
        asked = np.flatnonzero(absent[first + size] == absent[first])
        for some in np.split(asked, range(SEARCHED, len(asked), SEARCHED)):
            low, high = index.search(phrases.seq[first[some][:, None] + np.arange(size)])
            live = np.flatnonzero(high > low)
            if not len(live):
                continue
            count = high[live] - low[live]
            which = np.repeat(some[live], count)
            found = place[index.locate(np.repeat(low[live] - np.cumsum(count) + count, count) + np.arange(count.sum()))]
            np.add.at(depth, found, 1)
            np.add.at(depth, found + size, -1)
            pairs = np.unique(np.stack([doc[found], which]), axis=1)
            for d, w in pairs.T.tolist():
                items[d].update(owners[runs[w] : runs[w + 1]].tolist())
    covered = np.cumsum(depth)[:-1] > 0
    for k, n in enumerate(sizes):
        hits[k] = covered[start[k] : start[k] + n]
    return sizes, hits, items


def _shards(texts: list):
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t or "") // 5
        if n >= SHARD_WORDS:
            yield part
            part, n = [], 0
    if part:
        yield part


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The benchmark's items in blocks of about block_bytes, each collected by itself, so what is sent out is bounded."""
    plain = benchmark.select(F.col(item_col).cast("string").alias("k"), F.col(text_col).cast("string").alias("t"))
    size = plain.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    blocks = size // block_bytes + 1
    for b in range(blocks):
        yield [(r.k, r.t) for r in plain.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """docs with n_words, spans (covered word runs [start, end), merged) and items (sorted ids of the items that occur).

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. An item's windows are its runs of
    window words; one of fewer words, but not none, is a window itself. Each shard (a run of whole documents inside a
    task) gets an FM-index; backward search finds the windows, sampled suffixes locate them, spans merge. The texts are
    read once and never shuffled; the benchmark goes out in blocks of at most about block_bytes, one pass over the
    shard's rows each. A worker makes a block's windows once, as some arrays, for all its tasks. Null or wordless texts have no words. An item id that is null counts for spans but is not listed;
    repeated items are one. Rows stay as they are; the three new columns replace columns of the same names.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    out, texts_of = C.carried(docs, columns, text_col)
    out = out.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start:long,end:long>>"), "items": F.array().cast("array<string>")})
    schema = out.schema
    for items in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        sent, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches, sent=sent, name=name):
            phrases = C.worker_cache(("phrases", name), lambda: Phrases(sent.value, window))
            for batch in batches:
                texts = C.values(texts_of(batch))
                n, spans, found = [], [], []
                for shard, old, had in _zip_shards(texts, batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                    for size, hit, got, before, listed in zip(*shard_hits(shard, phrases), old, had):
                        for s in before:
                            hit[s["start"] : s["end"]] = True
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist()
                        n.append(size)
                        spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])])
                        found.append(sorted({phrases.items[k] for k in got} - {None} | set(listed)))
                new = {"n_words": pa.array(n, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "items": pa.array(found, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)
            C.give_back()

        out = out.mapInArrow(run, schema)
    return out.select(*C.out_of_one(columns), "n_words", "spans", "items")


def _zip_shards(texts, *others):
    at = 0
    for shard in _shards(texts):
        yield shard, *(x[at : at + len(shard)] for x in others)
        at += len(shard)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 10, drop: bool = True) -> DataFrame:
    """The rows of docs without contaminated ones (drop), or with the covered words cut out of their texts, where words
    are then joined by single spaces and lower case. Rows without a hit keep their text unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = find_contamination(docs.select(row, F.col(f"`{text_col}`").alias("_text")), benchmark, "_text", window=window)
    if drop:
        return found.where(F.size("spans") == 0).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])

    def cut(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist()):
                w, last, kept = words(text) if spans else [], 0, []
                for s in spans:
                    kept += w[last : s["start"]]
                    last = s["end"]
                out.append(b" ".join(kept + w[last:]).decode("utf-8", "replace") if spans else text)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.string())], ["_row", "_text"])

    kept = found.select("_row", "_text", "spans")
    kept = kept.mapInArrow(cut, T.StructType([kept.schema["_row"], T.StructField("_text", T.StringType())]))
    return kept.select(*[F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, C.table(spark, sf_dir, "benchmark"))
    hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start), F.lit(0).cast("long"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (hit > 0).alias("contaminated"))


#: Lists every window of every document: for the small tables of the tests.
OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS t FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT uid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT uid, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS i FROM d, (SELECT DISTINCT n FROM p))),
h AS (SELECT uid, i, g.n, item_id FROM g JOIN p ON g.n = p.n AND g.t = p.t),
c AS (SELECT uid, count(DISTINCT j) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS j FROM h) GROUP BY uid),
k AS (SELECT uid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM h GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (uid) LEFT JOIN k USING (uid)
"""
