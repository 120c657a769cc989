"""Exact removal of repeated word passages with difference-cover anchors (operator 1)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import common as C

CHUNK_WORDS = 1 << 19


class _Words(dict):
    """64-bit hashes of words; emptied before it grows past a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _chunks(texts: list):
    """(first row, word hashes, row of each word's document start offsets) over bounded runs of whole documents."""
    seen = C.worker_cache("words", _Words)
    first, ids, ends, total = 0, [], [], 0
    for row, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        ids.append(np.fromiter(map(seen.__getitem__, words), np.uint64, len(words)))
        total += len(words)
        ends.append(total)
        if total >= CHUNK_WORDS:
            yield first, np.concatenate(ids), np.array(ends)
            first, ids, ends, total = row + 1, [], [], 0
    if ids:
        yield first, np.concatenate(ids), np.array(ends)


def _owner(ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word: its document's number in the chunk, and the document's end."""
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    return doc[:n], np.repeat(ends, sizes)[:n]


def _anchors(ids, ends, window, period, cover):
    """Positions at the cover's residues (counted from the document's start), and the hash of the anchor there."""
    size = window - period + 1
    h = C.windows(ids, size)
    doc, end = _owner(ends, len(h))
    at = np.arange(len(h))
    start = np.concatenate([[0], ends[:-1]])[doc]
    picked = np.isin(np.arange(period), cover)[(at - start) % period] & (at + size <= end)
    at = np.flatnonzero(picked)
    return at, h[at] & C.TOP48, doc[at]


def _by_hash(h: np.ndarray, doc: np.ndarray):
    """Sorted distinct hashes, the least document of each, and whether another document has it as well."""
    order = np.argsort(h, kind="stable")
    s, d = h[order], doc[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, int)
    if not len(first):
        return s, d, np.zeros(0, bool)
    low, high = np.minimum.reduceat(d, first), np.maximum.reduceat(d, first)
    return s[first], low, low != high


def _rows_of(table) -> tuple[np.ndarray, list]:
    return table.column("id").to_numpy(), table.column("text").to_pylist()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, period: int = 7) -> DataFrame:
    """Remove each word covered by a window-word sequence that also starts in a document with a smaller id.

    Words are maximal runs of bytes other than ASCII white space. Any two equal windows, wherever they start, share an
    aligned anchor: a run of window-period+1 words at a position of a difference cover modulo period. Three narrow
    exchanges decide everything: (1) anchor hashes, one per group of documents, find the anchors that more than one
    document has; (2) the windows round those anchors are compared by 96-bit hashes, again one per group with the group's
    least id, so a passage that a third of all rows repeat costs one key a group; (3) each group learns which of its
    windows start in a smaller id elsewhere. Texts move once, and that exchange serves all passes.

    Returns doc_id, n_words, n_removed, spans (removed word runs [start, end)), kept_text, one row per input row.
    Null or empty text: no words, kept_text ''. Null ids sort last: such rows remove from nobody, and lose passages that
    rows with ids have. Rows with equal ids do not remove from each other. Other columns are not read.
    """
    spark, size = docs.sparkSession, C.text_bytes(docs, text_col)
    groups, buckets = C.group_count(spark, size), C.bucket_count(spark, size)
    cover = C.difference_cover(period)
    by_src = C.grouped_docs(docs, id_col, text_col, groups)

    def group_anchors(ids, texts):
        hs, ds = [], []
        for first, w, ends in _chunks(texts):
            _, h, doc = _anchors(w, ends, window, period, cover)
            hs.append(h)
            ds.append(ids[first + doc])
        return _by_hash(np.concatenate(hs or [np.zeros(0, np.uint64)]), np.concatenate(ds or [np.zeros(0, np.int64)]))

    def anchors(n: int):
        def run(t: pa.Table) -> pa.Table:
            keys, _, many = group_anchors(*_rows_of(t))
            return C.key_blocks(keys, many, t.column("src")[0].as_py(), n)

        return by_src.groupBy("src").applyInArrow(run, C.BLOCK_SCHEMA)

    def candidates(docs_t: pa.Table, found_t: pa.Table) -> pa.Table:
        if not docs_t.num_rows:
            return pa.table({k: pa.array([], t) for k, t in (("bucket", pa.int32()), ("src", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("low", pa.binary()))})
        src = docs_t.column("src")[0].as_py()
        ids, texts = _rows_of(docs_t)
        hs, at, docs_, parts = [], [], [], []
        for first, w, ends in _chunks(texts):
            p, h, doc = _anchors(w, ends, window, period, cover)
            parts.append((first, w, ends))
            hs.append(h), at.append(p), docs_.append(ids[first + doc])
        keys, _, many = _by_hash(np.concatenate(hs), np.concatenate(docs_))
        shared = np.sort(np.concatenate([keys[many], *(C.unpack48(x) for x in found_t.column("found").to_pylist())]))
        a, b, low = [], [], []
        for (first, w, ends), h, p in zip(parts, hs, at):
            near = np.zeros(len(w) + 1, np.int32)
            hit = p[C.members(h, shared)]
            np.add.at(near, np.maximum(hit - period + 1, 0), 1)
            np.add.at(near, hit + 1, -1)
            wh = C.windows(w, window)
            doc, end = _owner(ends, len(wh))
            pick = np.flatnonzero((np.cumsum(near)[: len(wh)] > 0) & (np.arange(len(wh)) + window <= end))
            a.append(wh[pick])
            b.append(C.windows(w, window, 0xD6E8FEB86659FD93)[pick].astype(np.uint32))
            low.append(ids[first + doc[pick]])
        a, b, low = map(np.concatenate, (a, b, low))
        order = np.lexsort((low, b, a))
        a, b, low = a[order], b[order], low[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
        a, b, low = a[new], b[new], low[new]
        cuts = C.bucket_cuts(a, buckets)
        full = np.flatnonzero(np.diff(cuts))
        cut = lambda x: pa.array([C.pack(x[cuts[i] : cuts[i + 1]]) for i in full], pa.binary())
        return pa.table({"bucket": pa.array(full, pa.int32()), "src": pa.array(np.full(len(full), src), pa.int32()), "a": cut(a), "b": cut(b), "low": cut(low)})

    def later(t: pa.Table) -> pa.Table:
        src = t.column("src").to_numpy()
        a = [C.unpack(x) for x in t.column("a").to_pylist()]
        sizes = [len(x) for x in a]
        a = np.concatenate(a)
        b = np.concatenate([C.unpack(x, np.uint32) for x in t.column("b").to_pylist()])
        low = np.concatenate([C.unpack(x, np.int64) for x in t.column("low").to_pylist()])
        order = np.lexsort((b, a))
        new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        least = np.minimum.reduceat(low[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        gone = np.empty(len(a), bool)
        gone[order] = low[order] > least
        out, start = [], 0
        for n in sizes:
            out.append(C.pack(a[start : start + n][gone[start : start + n]]))
            start += n
        keep = [i for i, x in enumerate(out) if x]
        return pa.table({"src": pa.array(src[keep], pa.int32()), "found": pa.array([out[i] for i in keep], pa.binary())})

    def finish(docs_t: pa.Table, gone_t: pa.Table) -> pa.Table:
        ids, texts = _rows_of(docs_t) if docs_t.num_rows else (np.zeros(0, np.int64), [])
        gone = np.sort(np.concatenate([np.zeros(0, np.uint64), *(C.unpack(x) for x in gone_t.column("found").to_pylist())]))
        hs, parts, lows = [], [], []
        for first, w, ends in _chunks(texts):
            h = C.windows(w, window)
            doc, end = _owner(ends, len(h))
            at = np.flatnonzero(np.arange(len(h)) + window <= end)
            hs.append(h[at]), lows.append(ids[first + doc[at]])
            parts.append((first, len(w), ends, at, doc[at]))
        keys, low, many = _by_hash(np.concatenate(hs or [np.zeros(0, np.uint64)]), np.concatenate(lows or [np.zeros(0, np.int64)]))
        keys, low = keys[many], low[many]  # windows that several documents of this group have
        n_words, n_removed, spans, kept = [], [], [], []
        for (first, n, ends, at, doc), h, mine in zip(parts, hs, lows):
            out = C.members(h, gone)
            if len(keys):
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                out |= (keys[i] == h) & (low[i] < mine)
            depth = np.zeros(n + 1, np.int32)
            np.add.at(depth, at[out], 1)
            np.add.at(depth, at[out] + window, -1)
            removed = np.cumsum(depth)[:n] > 0
            start = 0
            for k, end in enumerate(ends.tolist()):
                mask = removed[start:end]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                words = (texts[first + k] or "").encode("utf-8", "surrogatepass").split()
                keep, last = [], 0
                for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    keep += words[last:x]
                    last = y
                keep += words[last:]
                n_words.append(end - start)
                n_removed.append(int(mask.sum()))
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                kept.append(b" ".join(keep).decode("utf-8", "replace"))
                start = end
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "spans": pa.array(spans, span), "kept_text": pa.array(kept, pa.string())})

    found = C.shared_keys(anchors, groups, buckets)
    near = by_src.groupBy("src").cogroup(found.groupBy("src")).applyInArrow(candidates, "bucket int, src int, a binary, b binary, low binary")
    gone = near.groupBy("bucket").applyInArrow(later, C.SHARED_SCHEMA)
    out = by_src.groupBy("src").cogroup(gone.groupBy("src")).applyInArrow(finish, "id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string")
    return out.withColumn("id", C.public_id()).withColumnRenamed("id", id_col)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Every window of every document, so quadratic in nothing but large: for small tables.
OP1_SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS uid, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT uid, doc_id, unnest(range(1, greatest(len(ws) - 12, 0) + 1)) AS i, ws FROM w),
h AS (SELECT uid, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS t FROM g),
m AS (SELECT t, min(doc_id) AS low FROM h GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT uid, unnest(range(i, i + 13)) AS j FROM h JOIN m USING (t) WHERE low < doc_id),
gl AS (SELECT uid, list(j) AS js FROM gone GROUP BY uid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE list_filter(ws, lambda x, k: NOT list_contains(js, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gl USING (uid)
"""
