"""Helpers shared by the training-data operators: word splitting, hashing, packed key blocks, group counts."""

from __future__ import annotations

import ctypes
import gc
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.shared import checkpointed, remove, settled, shared_dir, text_batches  # noqa: F401  (for the operators)

#: Stands for a null id inside the operators: it sorts after every other id.
NO_ID = 2**63 - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_one(docs: DataFrame) -> DataFrame:
    """All columns as the fields of one column, row: whatever they are called, they clash with no name of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def out_of_one(columns: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in columns]


def carried(docs: DataFrame, columns: list[str], text_col: str):
    """(frame, texts): docs as one column, row, of the columns, for mapInArrow, which takes no names with dots; texts gives
    a batch's texts, from the row's own field where that is a string, so that no text goes along twice."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row") if columns else F.struct(F.lit(0).alias("none")).alias("row")
    if text_col in columns and docs.schema[text_col].dataType.simpleString() == "string":
        at = columns.index(text_col)
        return docs.select(row), lambda batch: batch.column("row").field(at)
    return docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text")), lambda batch: batch.column("text")


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts, measured: a narrow scan, whatever the frame comes from."""
    return int(docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")) + 16)).first()[0] or 0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def group_count(spark: SparkSession, size: int, group_bytes: int = 12 << 20) -> int:
    """Document groups of about group_bytes of text each, so that one group always fits in a worker."""
    return max(2 * partitions(spark), size // group_bytes + 1)


def bucket_count(spark: SparkSession, size: int, bucket_bytes: int = 64 << 20) -> int:
    """Ranges of keys, each with those of about bucket_bytes of text."""
    return max(partitions(spark), size // bucket_bytes + 1)


def grouped_docs(docs: DataFrame, id_col: str, text_col: str, groups: int) -> DataFrame:
    """(src, id, text): src deals the rows evenly by id and text, so null ids, or one id of many texts, are no hot group."""
    plain = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return plain.select(F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int").alias("src"), "id", "text")


def public_id(c: str | Column = "id") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != NO_ID, c)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place on a fresh array)."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def windows(ids: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hash of every run of size ids (empty if there are fewer)."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, b = ids[:n].copy(), np.uint64(base)
    for k in range(1, size):
        out *= b
        out += ids[k : k + n]
    return mix(out)


def difference_cover(period: int) -> list[int]:
    """A smallest set of residues of which some two differ by each residue modulo period."""
    from itertools import combinations

    for size in range(math.isqrt(period), period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    return list(range(period))


def pack(keys: np.ndarray) -> bytes:
    """A compressed block of unsigned keys; byte planes, so that the leading bytes of sorted keys take next to nothing."""
    keys = np.ascontiguousarray(keys)
    width = keys.dtype.itemsize
    planes = keys.view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes()) if len(keys) else b""


def unpack(block: bytes, dtype=np.uint64) -> np.ndarray:
    if not block:
        return np.zeros(0, dtype)
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(dtype).ravel()


def pack48(keys: np.ndarray) -> bytes:
    """The upper 48 bits of sorted 64-bit hashes: enough for a filter whose survivors are compared in full."""
    planes = np.ascontiguousarray(np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8).T[2:])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes()) if len(keys) else b""


def unpack48(block: bytes) -> np.ndarray:
    if not block:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(6, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, 2:] = raw.T
    return out.view(np.uint64).ravel()


TOP48 = np.uint64(0xFFFFFFFFFFFF0000)


def bucket_cuts(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of the buckets (equal ranges of the key space) starts in sorted 64-bit keys; one end more."""
    starts = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(sorted_keys, starts), len(sorted_keys))


def members(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


_cached: dict = {}


def worker_cache(name, make):
    """What an operator keeps in a Python worker between tasks. Workers outlive jobs, so a worker keeps one operator's
    cache at a time: that of another goes first."""
    if name not in _cached:
        drop_caches()
        _cached[name] = make()
    return _cached[name]


def drop_caches() -> None:
    """For tasks that keep nothing themselves: free what another operator has left in this worker."""
    if _cached:
        _cached.clear()
        gc.collect()  # an encoder and its functions name each other
    give_back()


def give_back() -> None:
    """Return what this worker has freed to the system: Arrow and the C library keep it, and an executor's other worker and
    its JVM need it while this one idles or does something smaller."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def values(column: pa.Array, rows: int = 256):
    """A column's values as Python's, a few rows at a time."""
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


BLOCK_SCHEMA = "bucket int, src int, keys binary, many binary"
SHARED_SCHEMA = "src int, found binary"
#: Key blocks up to which each group sends one to each bucket; beyond, they go by way of groups of groups.
MOST_BLOCKS = 1 << 22


def key_blocks(keys: np.ndarray, many: np.ndarray, src: int, buckets: int):
    """Sorted keys of a src, cut to buckets; many: which of them the src knows to be shared already."""
    cuts = bucket_cuts(keys, buckets)
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "bucket": pa.array(full, pa.int32()),
        "src": pa.array(np.full(len(full), src), pa.int32()),
        "keys": pa.array([pack48(keys[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
        "many": pa.array([np.packbits(many[cuts[b] : cuts[b + 1]]).tobytes() for b in full], pa.binary()),
    })


def _unpacked(table):
    blocks = [unpack48(x) for x in table.column("keys").to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(table.column("many").to_pylist(), blocks)]
    return table.column("src").to_numpy(), blocks, many


def _found(src, blocks, wanted):
    out = [pack48(k[w]) for k, w in zip(blocks, wanted)]
    keep = [i for i, x in enumerate(out) if x]
    return pa.table({"src": pa.array(np.asarray(src)[keep], pa.int32()), "found": pa.array([out[i] for i in keep], pa.binary())})


def find_shared(table):
    """Of a bucket's key blocks (src, keys, many): per src the keys that another src has too and it does not know to be
    shared."""
    src, blocks, many = _unpacked(table)
    keys = np.concatenate([np.zeros(0, np.uint64), *blocks])
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    twin = np.zeros(len(s), bool)
    twin[1:] |= same
    twin[:-1] |= same
    shared = np.empty(len(s), bool)
    shared[order] = twin
    cut = np.split(shared, np.cumsum([len(k) for k in blocks])[:-1]) if blocks else []
    return _found(src, blocks, [x & ~m for x, m in zip(cut, many)])


def _combined(blocks, many) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of several blocks, and whether two have a key or one knows it to be shared."""
    keys, known = np.concatenate([np.zeros(0, np.uint64), *blocks]), np.concatenate([np.zeros(0, bool), *many])
    order = np.argsort(keys, kind="stable")
    s, k = keys[order], known[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, int)
    if not len(first):
        return s, k
    return s[first], np.logical_or.reduceat(k, first) | (np.diff(np.append(first, len(s))) > 1)


def shared_keys(blocks_of, groups: int, buckets: int) -> DataFrame:
    """(src, found): of each src the keys that others have too. blocks_of(n) gives its key blocks for n buckets.

    With one block from each group to each bucket, blocks grow as the square of the corpus and end up with a key each. So
    beyond MOST_BLOCKS a group sends blocks to about the square root of the buckets; the blocks of as many groups meet in
    one task a coarse bucket, which sends their distinct keys on to the fine buckets as one source, and deals out what
    comes back. Blocks then grow with the power of one and a half, and each key moves twice.
    """
    if groups * buckets <= MOST_BLOCKS:
        return blocks_of(buckets).groupBy("bucket").applyInArrow(find_shared, SHARED_SCHEMA)
    coarse = math.isqrt(buckets - 1) + 1
    fine = coarse * -(-buckets // coarse)
    rows = blocks_of(coarse).withColumn("task", (F.floor(F.col("src") / coarse) * coarse + F.col("bucket")).cast("int"))

    def gather(t):
        _, blocks, many = _unpacked(t)
        return key_blocks(*_combined(blocks, many), t.column("task")[0].as_py(), fine)

    def deal(t, back):
        if not t.num_rows:
            return pa.table({"src": pa.array([], pa.int32()), "found": pa.array([], pa.binary())})
        src, blocks, many = _unpacked(t)
        keys, known = _combined(blocks, many)
        shared = np.sort(np.concatenate([keys[known], *(unpack48(x) for x in back.column("found").to_pylist())]))
        return _found(src, blocks, [members(k, shared) & ~m for k, m in zip(blocks, many)])

    back = rows.groupBy("task").applyInArrow(gather, BLOCK_SCHEMA).groupBy("bucket").applyInArrow(find_shared, SHARED_SCHEMA)
    return rows.groupBy("task").cogroup(back.groupBy("src")).applyInArrow(deal, SHARED_SCHEMA)
