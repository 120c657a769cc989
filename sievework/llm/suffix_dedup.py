"""Exact removal of repeated byte strings by a distributed sparse suffix array (operator 10)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import common as C

CHUNK_BYTES = 1 << 20
_B = 0xB5297A4D3F84D5B5  # odd, so that its powers have inverses modulo 2**64
_INV = pow(_B, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The base's powers and their inverses, kept for the largest chunk seen."""
    tables = C.worker_cache("powers", dict)
    if len(tables.get("p", ())) < n:
        for name, base in (("p", _B), ("i", _INV)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            tables[name] = np.multiply.accumulate(x)
        tables["t"] = C.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return tables["p"], tables["i"], tables["t"]


def _sliding(x: np.ndarray, size: int, f) -> np.ndarray:
    """f (minimum or maximum) over each run of size values."""
    width = 1
    while 2 * width <= size:
        x = f(x[:-width], x[width:])
        width *= 2
    return f(x[: len(x) - (size - width)], x[size - width :]) if width < size else x


def _chunks(raws: list[bytes]):
    """(first row, bytes, ends) over bounded runs of whole documents."""
    first, part, ends, total = 0, [], [], 0
    for row, raw in enumerate(raws):
        part.append(raw)
        total += len(raw)
        ends.append(total)
        if total >= CHUNK_BYTES:
            yield first, b"".join(part), np.array(ends)
            first, part, ends, total = row + 1, [], [], 0
    if part:
        yield first, b"".join(part), np.array(ends)


def _suffixes(buf: bytes, ends: np.ndarray, length: int, token: int):
    """The sampled suffixes of a chunk.

    A suffix is sampled if its leading token (token bytes) has the least hash of all that start in some string of length
    bytes inside one document, so each such string holds a sampled suffix, at a place that its content alone decides.
    Returns positions, token hashes, document numbers, bytes to the left and right within reach, and context hashes.
    """
    raw = np.frombuffer(buf, np.uint8)
    n, reach = len(raw), length - token
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    power, inverse, spread = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(spread[raw] * power[:n], out=sums[1:])
    h = C.mix((sums[token:] - sums[:-token]) * inverse[: n - token + 1])
    rank = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = _sliding(rank, reach + 1, np.minimum)
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    end_of = np.repeat(ends, sizes)
    low[np.arange(len(low)) + length > end_of[: len(low)]] = 0
    high = _sliding(np.concatenate([np.zeros(reach, np.uint32), low, np.zeros(reach, np.uint32)]), reach + 1, np.maximum)
    at = np.flatnonzero(high[: len(rank)] == rank)
    start = (ends - sizes)[doc[at]]
    left = np.minimum(at - start, reach)
    right = np.minimum(end_of[at] - at, length)
    around = (sums[at + right] - sums[at - left]) * inverse[at - left]
    around = C.mix(around + C.mix(left.astype(np.uint64) * np.uint64(257) + right.astype(np.uint64)))
    return at, h[at], doc[at], left, right, around


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings of one width, and of each but the first how many leading bytes it shares with the one before.

    Multikey quicksort on characters of eight bytes: all are sorted by their first character, and only those that tie go
    on to the next, each run of ties by itself.
    """
    n, width = rows.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    keys = wide.view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    split = np.append(True, np.diff(keys[order, 0]) != 0) if n else np.zeros(0, bool)
    for k in range(1, keys.shape[1]):
        run = np.cumsum(split) - 1
        tied = np.flatnonzero(np.bincount(run, minlength=1)[run] > 1) if n else np.zeros(0, int)
        if not len(tied):
            break
        o = order[tied]
        by = np.lexsort((keys[o, k], run[tied]))
        order[tied] = o[by]
        v, r = keys[order[tied], k], run[tied]
        split[tied[1:]] |= (v[1:] != v[:-1]) & (r[1:] == r[:-1])
    shared = np.zeros(n, np.int64)
    if n > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, shared


def _classes(order: np.ndarray, shared: np.ndarray, size: int) -> np.ndarray:
    """Of each string, the number of its class of strings with the same size leading bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < size)
    return out


#: Ranges of leading tokens at most (a splitter goes to every task); beyond, a range is dealt on by a hash of the token.
MOST_RANGES = 1 << 16


def _splitters(docs: DataFrame, text_col: str, length: int, token: int, ranges: int, sample_docs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading tokens that cut the sampled suffixes of a bounded sample of documents into even ranges, and the tokens that
    would fill a range or more by themselves (both for balance only; no more than ranges of either)."""
    none = np.zeros(0, f"S{token}")
    total = docs.count()
    if not total:
        return none, none

    def tokens(batches):
        for batch in batches:
            out = []
            for _, buf, ends in _chunks([(x or "").encode("utf-8", "surrogatepass") for x in batch.column("t").to_pylist()]):
                at = _suffixes(buf, ends, length, token)[0]
                out += [buf[i : i + token] for i in at[:: max(1, len(at) // 2000)].tolist()]
            yield pa.RecordBatch.from_pydict({"t": pa.array(out, pa.binary())})

    few = docs.select(F.col(f"`{text_col}`").cast("string").alias("t")).sample(False, min(1.0, sample_docs / total), seed).limit(2 * sample_docs)
    seen = np.sort(np.array(few.mapInArrow(tokens, "t binary").limit(400_000).toArrow().column("t").to_pylist(), dtype=f"S{token}"))
    if not len(seen):
        return none, none
    values, counts = np.unique(seen, return_counts=True)
    return np.unique(seen[np.linspace(0, len(seen), ranges + 1).astype(int)[1:-1]]), values[counts > max(len(seen) / ranges, HOT_SEEN)]


#: A token is hot only if the sample has it more often than this.
HOT_SEEN = 8


def _string_keys(text: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, reach: int):
    """Of contexts (rows of bytes round a suffix) all strings of length bytes that hold the suffix's token: row number,
    offset (bytes before the suffix), and two 64-bit hashes of the string."""
    none = np.zeros(0, np.uint64)
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [none], [none]]
    power, inverse, spread = _powers(text.shape[1] + 1)
    other = C.mix(spread + np.uint64(0xD6E8FEB86659FD93))
    for first in range(0, len(text), 2048):
        part, l, r = text[first : first + 2048], left[first : first + 2048], right[first : first + 2048]
        row, off = np.nonzero((l[:, None] >= np.arange(reach + 1)) & (r[:, None] >= length - np.arange(reach + 1)))
        start = reach - off
        for kept, table in ((out[2], spread), (out[3], other)):
            sums = np.zeros((len(part), text.shape[1] + 1), np.uint64)
            np.cumsum(table[part] * power[: text.shape[1]], axis=1, out=sums[:, 1:])
            kept.append(C.mix((sums[row, start + length] - sums[row, start]) * inverse[start]))
        out[0].append(first + row), out[1].append(off)
    return tuple(map(np.concatenate, out))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, token: int = 32, sample_docs: int = 1000, seed: int = 13) -> DataFrame:
    """Remove each byte covered by a length-byte string that also starts earlier (smaller id, or same id, earlier start).

    A suffix array over every byte would move eight times the corpus, so the array is sparse: a string of length bytes
    always holds a suffix whose leading token hashes lowest, and such suffixes alone (about one byte in 35) are kept.
    Those whose leading token occurs once are settled by a narrow exchange of token hashes. The rest travel with the
    bytes in reach, once for each group of documents and context, to ranges cut by sampled splitters; a range sorts its
    suffixes by multikey quicksort, and likewise what stands before them, and classes of equal strings are runs of both
    orders. A splitter is a whole leading token and a string never reaches before its suffix's token is complete, so
    equal strings never lie across a boundary: the comparison there is that of the tokens alone. All offsets of a string
    round its suffix are compared byte by byte; hashes only choose the candidates and name contexts within a group.
    A token that would fill a range by itself (one passage in very many documents, each with its own surroundings) has no
    range: the strings round it go by 128 bits of hash to buckets of their own, one row for each distinct string and group,
    and the least place of each decides; so no task holds the contexts of one token.

    Returns doc_id, n_bytes, n_removed, spans (maximal removed runs [start, end) of bytes), kept (binary), one row per
    input row. Null or empty text: no bytes. Null ids sort last. Rows with equal ids count as one place: equal starts of
    them do not remove each other, later starts do. Other columns are not read.
    """
    spark, size = docs.sparkSession, C.text_bytes(docs, text_col)
    groups, buckets = C.group_count(spark, size), C.bucket_count(spark, size)
    ranges = 2 * C.bucket_count(spark, size, 14 << 20)
    deals = ranges // MOST_RANGES + 1
    ranges = min(ranges, MOST_RANGES)
    reach, width = length - token, 2 * length - token
    by_src = C.grouped_docs(docs, id_col, text_col, groups)
    splitters, hot = _splitters(docs, text_col, length, token, ranges, sample_docs, seed)

    def rows_of(t):
        return t.column("id").to_numpy(), [(x or "").encode("utf-8", "surrogatepass") for x in t.column("text").to_pylist()]

    def token_counts(hashes):
        s = np.sort(np.concatenate([np.zeros(0, np.uint64), *hashes]) & C.TOP48)
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, int)
        return s[first], np.diff(np.append(first, len(s))) > 1

    def tokens(n: int):
        def run(t: pa.Table) -> pa.Table:
            keys, many = token_counts([_suffixes(buf, ends, length, token)[1] for _, buf, ends in _chunks(rows_of(t)[1])])
            return C.key_blocks(keys, many, t.column("src")[0].as_py(), n)

        return by_src.groupBy("src").applyInArrow(run, C.BLOCK_SCHEMA)

    def contexts(docs_t: pa.Table, found_t: pa.Table) -> pa.Table:
        names = ("left", "right", "around", "id", "pos", "text")
        if not docs_t.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "src": pa.array([], pa.int32())} | {k: pa.array([], pa.binary()) for k in names})
        src = docs_t.column("src")[0].as_py()
        ids, raws = rows_of(docs_t)
        parts, hashes = [], []
        for first, buf, ends in _chunks(raws):
            at, h, doc, left, right, around = _suffixes(buf, ends, length, token)
            hashes.append(h)
            parts.append((buf, at, ids[first + doc], at - np.concatenate([[0], ends])[doc], left, right, around))
        keys, many = token_counts(hashes)
        shared = np.sort(np.concatenate([keys[many], *(C.unpack48(x) for x in found_t.column("found").to_pylist())]))
        got: list[list] = [[] for _ in range(6)]
        for (buf, at, doc, pos, left, right, around), h in zip(parts, hashes):
            k = np.flatnonzero(C.members(h & C.TOP48, shared))
            k = k[np.lexsort((pos[k], doc[k], around[k]))]
            k = k[np.append(True, around[k][1:] != around[k][:-1])] if len(k) else k
            raw = np.concatenate([np.zeros(reach, np.uint8), np.frombuffer(buf, np.uint8), np.zeros(length, np.uint8)])
            text = raw[at[k][:, None] + np.arange(width)]
            off = np.arange(width) - reach
            text[(off < -left[k][:, None]) | (off >= right[k][:, None])] = 0
            for x, y in zip(got, (left[k].astype(np.uint8), right[k].astype(np.uint8), around[k], doc[k], pos[k].astype(np.int64), text)):
                x.append(y)
        left, right, around, doc, pos, text = map(np.concatenate, got)
        order = np.lexsort((pos, doc, around))
        order = order[np.append(True, around[order][1:] != around[order][:-1])] if len(order) else order
        lead = leads(text[order])
        strings = hot_strings(order[np.isin(lead, hot)], text, left, right, doc, pos)
        order, lead = order[keep := ~np.isin(lead, hot)], lead[keep]
        bucket = np.searchsorted(splitters, lead, side="right") if len(splitters) else np.zeros(len(order), int)
        if deals > 1:
            bucket = bucket * deals + C.mix(np.ascontiguousarray(text[order, reach : reach + 8]).view(np.uint64).ravel()).astype(np.int64) % deals
        order, bucket = order[by := np.lexsort((lead, bucket))], bucket[by]
        full, starts = np.unique(bucket, return_index=True)
        cut = [order[a:b] for a, b in zip(starts, np.append(starts[1:], len(order)))]
        text_block = lambda k: C.zstandard.ZstdCompressor(level=3).compress(text[k].tobytes())
        ranged = pa.table({
            "bucket": pa.array(full, pa.int32()),
            "src": pa.array(np.full(len(full), src), pa.int32()),
            **{name: pa.array([C.pack(x[k]) for k in cut], pa.binary()) for name, x in zip(names, (left, right, around, doc, pos))},
            "text": pa.array([text_block(k) for k in cut], pa.binary()),
        })
        a, b, low_doc, low_pos = strings
        cuts = C.bucket_cuts(a, buckets)
        full = np.flatnonzero(np.diff(cuts))
        some = lambda x: pa.array([C.pack(x[cuts[i] : cuts[i + 1]]) for i in full], pa.binary())
        empty = pa.array([b""] * len(full), pa.binary())
        hashed = pa.table({"bucket": pa.array(-1 - full, pa.int32()), "src": pa.array(np.full(len(full), src), pa.int32()), "left": empty, "right": empty, "around": some(a), "id": some(low_doc), "pos": some(low_pos), "text": some(b)})
        return pa.concat_tables([ranged, hashed])

    def leads(text):
        return np.ascontiguousarray(text[:, reach : reach + token]).view(f"S{token}").ravel()

    def hot_strings(k, text, left, right, doc, pos):
        """The distinct strings of contexts k, sorted: their two hashes, and the least place of each."""
        row, off, a, b = _string_keys(text[k], left[k].astype(np.int64), right[k].astype(np.int64), length, reach)
        d, p = doc[k][row], pos[k][row] - off
        order = np.lexsort((p, d, b, a))
        a, b, d, p = a[order], b[order], d[order], p[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
        return a[new], b[new], d[new], p[new]

    def later_strings(t: pa.Table) -> pa.Table:
        """Of a bucket's strings those whose group has them first at a later place than another group."""
        src = t.column("src").to_numpy()
        read = lambda name, kind: [C.unpack(x, kind) for x in t.column(name).to_pylist()]
        keys = read("around", np.uint64)
        sizes = [len(x) for x in keys]
        a, b, d, p = np.concatenate(keys), *(np.concatenate(read(n, kind)) for n, kind in (("text", np.uint64), ("id", np.int64), ("pos", np.int64)))
        order = np.lexsort((p, d, b, a))
        new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = np.empty(len(a), bool)
        gone[order] = (d[order] != d[first]) | (p[order] != p[first])
        cut = np.split(np.arange(len(a)), np.cumsum(sizes)[:-1])
        kept = [(s, x[gone[x]]) for s, x in zip(src, cut) if gone[x].any()]
        return pa.table({"src": pa.array([s for s, _ in kept], pa.int32()), "hot": pa.array([True] * len(kept), pa.bool_()), "around": pa.array([C.pack(a[x]) for _, x in kept], pa.binary()), "bits": pa.array([C.pack(b[x]) for _, x in kept], pa.binary())})

    def compare(t: pa.Table) -> pa.Table:
        if t.column("bucket")[0].as_py() < 0:
            return later_strings(t)
        src = t.column("src").to_numpy()
        read = lambda name, kind: [C.unpack(x, kind) for x in t.column(name).to_pylist()]
        arounds = read("around", np.uint64)
        sizes = [len(x) for x in arounds]
        left, right = np.concatenate(read("left", np.uint8)).astype(int), np.concatenate(read("right", np.uint8)).astype(int)
        doc, pos = np.concatenate(read("id", np.int64)), np.concatenate(read("pos", np.int64))
        text = np.frombuffer(b"".join(C.zstandard.ZstdDecompressor().decompress(x) for x in t.column("text").to_pylist()), np.uint8).reshape(-1, width)
        order, after = multikey_sort(text[:, reach:])
        order_l, before = multikey_sort(np.ascontiguousarray(text[:, :reach][:, ::-1]))
        place = np.lexsort((pos, doc))  # earlier places get smaller numbers, equal places the same
        number = np.empty(len(place), np.int64)
        number[place] = np.cumsum(np.append(False, (np.diff(doc[place]) != 0) | (np.diff(pos[place]) != 0))) if len(place) else 0
        flags = np.zeros((len(text), reach + 1), bool)
        for a in range(reach + 1):
            k = np.flatnonzero((left >= a) & (right >= length - a))
            if not len(k):
                continue
            both = _classes(order, after, length - a)[k] * (len(text) + 1) + (_classes(order_l, before, a)[k] if a else 0)
            by = np.argsort(both, kind="stable")
            new = np.append(True, np.diff(both[by]) != 0)
            least = np.minimum.reduceat(number[k][by], np.flatnonzero(new))[np.cumsum(new) - 1]
            flags[k[by], a] = number[k][by] > least
        out_src, out_key, out_bits, start = [], [], [], 0
        for s, n, around in zip(src, sizes, arounds):
            k = np.flatnonzero(flags[start : start + n].any(axis=1))
            if len(k):
                out_src.append(s)
                out_key.append(C.pack(around[k]))
                out_bits.append(C.zstandard.ZstdCompressor(level=1).compress(np.packbits(flags[start + k], axis=1).tobytes()))
            start += n
        return pa.table({"src": pa.array(out_src, pa.int32()), "hot": pa.array([False] * len(out_src), pa.bool_()), "around": pa.array(out_key, pa.binary()), "bits": pa.array(out_bits, pa.binary())})

    def finish(docs_t: pa.Table, gone_t: pa.Table) -> pa.Table:
        ids, raws = rows_of(docs_t) if docs_t.num_rows else (np.zeros(0, np.int64), [])
        is_hot = gone_t.column("hot").to_numpy(zero_copy_only=False).astype(bool) if gone_t.num_rows else np.zeros(0, bool)
        hot_t, gone_t = gone_t.filter(pa.array(is_hot, pa.bool_())), gone_t.filter(pa.array(~is_hot, pa.bool_()))
        key = np.concatenate([np.zeros(0, np.uint64), *(C.unpack(x) for x in gone_t.column("around").to_pylist())])
        bits = np.frombuffer(b"".join(C.zstandard.ZstdDecompressor().decompress(x) for x in gone_t.column("bits").to_pylist()), np.uint8).reshape(len(key), -1 if len(key) else 1)
        by = np.argsort(key)
        key, bits = key[by], bits[by]
        parts = []
        for first, buf, ends in _chunks(raws):
            at, _, doc, left, right, around = _suffixes(buf, ends, length, token)
            parts.append((first, len(buf), ends, at, ids[first + doc], at - np.concatenate([[0], ends])[doc], left, right, around))
        every = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (4, 5, 8)]
        by = np.lexsort((every[1], every[0], every[2]))
        new = np.append(True, np.diff(every[2][by]) != 0) if len(by) else np.zeros(0, bool)
        head = by[np.flatnonzero(new)][np.cumsum(new) - 1] if len(by) else by
        later = np.zeros(len(by), bool)  # not the first place of its context in this group
        later[by] = (every[0][by] != every[0][head]) | (every[1][by] != every[1][head])
        strings = removed_strings(parts, raws, later, hot_t)
        n_bytes, n_removed, spans, kept, seen = [], [], [], [], 0
        for number, (first, n, ends, at, _, _, left, right, around) in enumerate(parts):
            whole = later[seen : seen + len(at)]
            seen += len(at)
            depth = np.zeros(n + 1, np.int32)
            # a context that is in this group before: every string round the suffix, so all bytes in reach
            k = np.flatnonzero(whole & (left + right >= length))
            np.add.at(depth, at[k] - left[k], 1)
            np.add.at(depth, at[k] + right[k], -1)
            k = np.flatnonzero(~whole & C.members(around, key))
            if len(k):
                own = np.unpackbits(bits[np.searchsorted(key, around[k])], axis=1, count=reach + 1)
                which, a = np.nonzero(own)
                np.add.at(depth, at[k][which] - a, 1)
                np.add.at(depth, at[k][which] - a + length, -1)
            if len(strings[number]):
                np.add.at(depth, strings[number], 1)
                np.add.at(depth, strings[number] + length, -1)
            removed = np.cumsum(depth)[:n] > 0
            start = 0
            for i, end in enumerate(ends.tolist()):
                mask, raw = removed[start:end], raws[first + i]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()
                cuts = [0, *edge, end - start]
                n_bytes.append(end - start)
                n_removed.append(int(mask.sum()))
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2], edge[1::2])])
                kept.append(b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2])))
                start = end
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array(ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    def removed_strings(parts, raws, later, hot_t) -> list[np.ndarray]:
        """By part the starts of strings round hot tokens that begin earlier: in this group, or by what came back."""
        out = [np.zeros(0, np.int64) for _ in parts]
        if not len(hot):
            return out
        got, seen = [], 0
        for number, (first, n, ends, at, doc, pos, left, right, _) in enumerate(parts):
            k = np.flatnonzero(~later[seen : seen + len(at)])
            seen += len(at)
            buf = np.frombuffer(b"".join(raws[first : first + len(ends)]), np.uint8)
            raw = np.concatenate([np.zeros(reach, np.uint8), buf, np.zeros(length, np.uint8)])
            lead = np.ascontiguousarray(raw[at[k][:, None] + reach + np.arange(token)]).view(f"S{token}").ravel()
            k = k[np.isin(lead, hot)]
            row, off, a, b = _string_keys(raw[at[k][:, None] + np.arange(width)], left[k], right[k], length, reach)
            got.append((np.full(len(row), number), at[k][row] - off, doc[k][row], pos[k][row] - off, a, b))
        number, start, doc, pos, a, b = (np.concatenate(x) for x in zip(*got)) if got else [np.zeros(0, np.int64)] * 6
        if not len(a):
            return out
        order = np.lexsort((pos, doc, b, a))
        new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = np.empty(len(a), bool)
        gone[order] = (doc[order] != doc[head]) | (pos[order] != pos[head])
        pairs = [np.concatenate([np.zeros(0, np.uint64), *(C.unpack(x) for x in hot_t.column(c).to_pylist())]) for c in ("around", "bits")]
        known = np.rec.fromarrays(pairs, names="a,b")
        gone |= np.isin(np.rec.fromarrays([a, b], names="a,b").view([("", np.uint64)] * 2), known.view([("", np.uint64)] * 2)) if len(known) else False
        for i in range(len(parts)):
            out[i] = start[gone & (number == i)]
        return out

    found = C.shared_keys(tokens, groups, buckets)
    near = by_src.groupBy("src").cogroup(found.groupBy("src")).applyInArrow(contexts, "bucket int, src int, left binary, right binary, around binary, id binary, pos binary, text binary")
    gone = near.groupBy("bucket").applyInArrow(compare, "src int, hot boolean, around binary, bits binary")
    out = by_src.groupBy("src").cogroup(gone.groupBy("src")).applyInArrow(finish, "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumn("id", C.public_id()).withColumnRenamed("id", id_col)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
