"""Phrase collocations by hierarchical pair naming (operator 12)."""

from __future__ import annotations

import json
import math
import string
import zlib
from array import array
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import common as C
from sievework.sources.shared import scratch

#: Characters that end a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
LEAST = 30
COVER = 80
MOST = 2000
#: Words of a chunk: texts whose words and pairs are counted together before anything is shuffled.
CHUNK_WORDS = 4 << 20
#: Bytes of text whose keys share a bucket.
BUCKET_BYTES = 32 << 20
#: Blocks of keys up to which each chunk sends one to each bucket; beyond, they go by way of groups of chunks.
MOST_BLOCKS = 1 << 22
#: Chunks are numbered within their partition.
CHUNK_BITS = 12
TOP_SLICES = 256
_PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + BREAKS, string.ascii_lowercase.encode() + b"." * len(BREAKS))
#: What the bucket column says of rows that are no blocks: a chunk's places; a language's words.
PLACES, WORDS = -1, -2
BLOCKS = "chunk long, bucket int, base int, a binary, b binary, n binary, lang string, words long"
FOUND = "chunk long, local binary, ids binary, id long, left long, right long, word string, a long"


def packed(places: np.ndarray) -> bytes:
    """Places as byte planes, compressed a little harder than keys: they are most of what moves."""
    planes = np.ascontiguousarray(places.astype(np.uint32)).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes()) if len(places) else b""


def rows_of(schema: str, rows: list[dict]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))})


class Words:
    """Keys of the first level: language and word as one byte string, which holds no line end."""

    @staticmethod
    def key(lang: str) -> bytes:
        """What stands before the words of a language."""
        return json.dumps(lang).encode() + b"\t"

    @staticmethod
    def pack(keys: np.ndarray) -> dict[str, bytes]:
        return {"a": zstandard.ZstdCompressor(level=1).compress(b"\n".join(keys)), "b": b""}

    @staticmethod
    def unpack(a: bytes, b: bytes) -> np.ndarray:
        words = zstandard.ZstdDecompressor().decompress(a).split(b"\n")
        out = np.empty(len(words), object)
        out[:] = words
        return out

    @staticmethod
    def bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % buckets

    @staticmethod
    def codes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each key's place among the distinct ones, and these."""
        found = pa.array(keys, pa.binary()).dictionary_encode()
        different = np.empty(len(found.dictionary), object)
        different[:] = found.dictionary.to_pylist()
        return found.indices.to_numpy(), different

    @staticmethod
    def head(key: bytes) -> dict:
        return {"word": key.decode()}


class Pairs:
    """Keys of the other levels: the names of both parents, as a row of two numbers."""

    @staticmethod
    def pack(keys: np.ndarray) -> dict[str, bytes]:
        return {"a": C.pack(np.ascontiguousarray(keys[:, 0]).view(np.uint64)), "b": C.pack(np.ascontiguousarray(keys[:, 1]).view(np.uint64))}

    @staticmethod
    def unpack(a: bytes, b: bytes) -> np.ndarray:
        return np.stack([C.unpack(a).view(np.int64), C.unpack(b).view(np.int64)], 1)

    @staticmethod
    def bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
        left, right = keys.astype(np.uint64).T
        return (C.mix(C.mix(left) + right) % np.uint64(buckets)).astype(np.int64)

    @staticmethod
    def codes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        s = keys[order]
        new = np.append(True, (s[1:] != s[:-1]).any(1)) if len(s) else np.zeros(0, bool)
        code = np.empty(len(keys), np.int64)
        code[order] = np.cumsum(new) - 1
        return code, s[new]

    @staticmethod
    def head(key: np.ndarray) -> dict:
        return {"left": int(key[0]), "right": int(key[1])}


def blocks_of(kind, chunk: int, keys: np.ndarray, counts: np.ndarray, fine: int, coarse: int):
    """(rows, order): a row for each of the coarse buckets that has keys, which lie in it by fine bucket; order is the keys'
    place in the rows, where key k has number k + 1 (base: numbers before the row)."""
    bucket = kind.bucket(keys, fine)
    order = np.argsort(bucket, kind="stable")
    group = bucket[order] // (fine // coarse)
    cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)) if len(group) else np.zeros(0, int)
    rows = [{"chunk": chunk, "bucket": int(group[i]), "base": int(i), **kind.pack(keys[order[i:j]]), "n": C.pack(counts[order[i:j]].astype(np.uint64))} for i, j in zip(cuts[:-1], cuts[1:])]
    return rows, order


def word_chunks(fine: int, coarse: int):
    """Of (lang, text) batches: chunks of about CHUNK_WORDS words as blocks of words with counts, the languages' words, and
    the texts as numbers; 0 stands between pieces."""

    def run(batches):
        C.drop_caches()
        numbered = count(TaskContext.get().partitionId() << CHUNK_BITS)
        langs, at, fresh = {}, array("i"), count(1)

        def full():
            chunk, places = next(numbered), np.frombuffer(at, np.int32)
            keys = np.empty(sum(len(x) - 1 for x in langs.values()), object)
            counts = np.bincount(places, minlength=len(keys) + 1)[1:]
            words = {}
            for lang, numbers in langs.items():
                own, before = np.fromiter(numbers.values(), np.int64, len(numbers))[1:] - 1, Words.key(lang)
                keys[own] = [before + w for w in islice(numbers, 1, None)]
                words[lang] = int(counts[own].sum())
            langs.clear()
            rows, order = blocks_of(Words, chunk, keys, counts, fine, coarse)
            number = np.zeros(len(keys) + 1, np.uint32)
            number[order + 1] = np.arange(1, len(keys) + 1)
            rows += [{"chunk": chunk, "bucket": WORDS, "lang": lang, "words": n} for lang, n in words.items()]
            rows.append({"chunk": chunk, "bucket": PLACES, "a": packed(number[places])})
            return rows_of(BLOCKS, rows).to_batches()

        for batch in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if lang not in langs:
                    langs[lang] = defaultdict(fresh.__next__, {b".": 0})
                at.extend(map(langs[lang].__getitem__, text.translate(_PLAIN).replace(b".", b" . ").split()))
                at.append(0)
                if len(at) >= CHUNK_WORDS:
                    yield from full()
                    langs, at, fresh = {}, array("i"), count(1)
        if langs:
            yield from full()

    return run


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, each key's place among them in 32 bits, and their counts: np.unique in less memory."""
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    place = np.empty(len(key), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    del order
    first = np.flatnonzero(new)
    return key[first], place, np.diff(np.append(first, len(key)))


def pair_chunks(fine: int, coarse: int, last: bool):
    """For cogroup: of a chunk's places and the names of what is frequent there, the blocks of pairs of neighbouring names.
    last: no level follows, so pairs need no places."""

    def run(places: pa.Table, names: pa.Table) -> pa.Table:
        if not places.num_rows or not names.num_rows:
            return rows_of(BLOCKS, [])
        chunk, at = places.column("chunk")[0].as_py(), C.unpack(places.column("a")[0].as_py(), np.uint32)
        local = np.concatenate([C.unpack(x, np.uint32) for x in names.column("local").to_pylist()])
        ids = np.concatenate([C.unpack(x) for x in names.column("ids").to_pylist()]).view(np.int64)
        m = len(ids)
        rank = np.full(int(at.max(initial=0)) + 1, -1, np.int32)
        rank[local] = np.arange(m)
        name = rank[at]
        del at, rank, local
        named = name >= 0
        name = name[named | np.append(True, named[:-1])]  # one place is enough between two stretches of names
        pair = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0)).astype(np.int32)
        kinds, number, counts = distinct(name[pair].astype(np.int64) * m + name[pair + 1])
        rows, order = blocks_of(Pairs, chunk, np.stack([ids[kinds // m], ids[kinds % m]], 1), counts, fine, coarse)
        if not last:
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(1, len(order) + 1)
            at = np.zeros(len(name), np.uint32)
            at[pair] = place[number]
            rows.append({"chunk": chunk, "bucket": PLACES, "a": packed(at)})
        return rows_of(BLOCKS, rows)

    return run


def unpacked(kind, blocks: pa.Table):
    """(code of each key of all blocks, the distinct keys, their summed counts, bounds of the blocks)."""
    keys = [kind.unpack(a, b) for a, b in zip(blocks.column("a").to_pylist(), blocks.column("b").to_pylist())]
    counts = np.concatenate([C.unpack(x) for x in blocks.column("n").to_pylist()]).astype(np.int64)
    code, different = kind.codes(np.concatenate(keys))
    sums = np.zeros(len(different), np.int64)
    np.add.at(sums, code, counts)
    return code, different, sums, np.append(0, np.cumsum([len(k) for k in keys]))


def found_rows(blocks: pa.Table, code: np.ndarray, bounds: np.ndarray, ids: np.ndarray) -> list[dict]:
    """For each block the numbers of its keys that have a name (ids: by code, -1 for none), and the names."""
    out = []
    for k, (chunk, base) in enumerate(zip(blocks.column("chunk").to_pylist(), blocks.column("base").to_pylist())):
        got = ids[code[bounds[k] : bounds[k + 1]]]
        if len(at := np.flatnonzero(got >= 0)):
            out.append({"chunk": chunk, "local": C.pack((at + base + 1).astype(np.uint32)), "ids": C.pack(got[at].view(np.uint64))})
    return out


def names(kind, least: int):
    """Of a bucket's blocks: the frequent keys, numbered, as rows of their own; and where each block has them."""

    def run(blocks: pa.Table) -> pa.Table:
        code, different, sums, bounds = unpacked(kind, blocks)
        often = np.flatnonzero(sums >= least)
        ids = np.full(len(different), -1, np.int64)
        ids[often] = (blocks.column("bucket")[0].as_py() << 32) + np.arange(len(often))
        heads = [{"id": int(ids[k]), "a": int(sums[k]), **kind.head(different[k])} for k in often]
        return rows_of(FOUND, heads + found_rows(blocks, code, bounds, ids))

    return run


def named(blocks: DataFrame, kind, least: int, fine: int, coarse: int) -> DataFrame:
    """FOUND rows of the frequent keys of all blocks.

    With a block from each chunk to each bucket, blocks would grow as the square of the corpus and end up with a key each.
    So beyond MOST_BLOCKS chunks send to about the square root of the buckets; the blocks of as many chunks meet in a task
    a coarse bucket, which sends their distinct keys with their sums on to the fine buckets as one chunk, and deals out the
    names that come back. Blocks then grow with the power of one and a half, and each key moves twice.
    """
    if coarse == fine:
        return blocks.groupBy("bucket").applyInArrow(names(kind, least), FOUND)
    rows = blocks.withColumn("task", F.shiftright("chunk", CHUNK_BITS).cast("long"))
    rows = rows.withColumn("task", F.floor(F.col("task") / coarse).cast("long") * coarse + F.col("bucket"))

    def gather(t: pa.Table) -> pa.Table:
        _, different, sums, _ = unpacked(kind, t)
        return rows_of(BLOCKS, blocks_of(kind, t.column("task")[0].as_py(), different, sums, fine, fine)[0])

    def deal(t: pa.Table, back: pa.Table) -> pa.Table:
        if not t.num_rows or not back.num_rows:
            return rows_of(FOUND, [])
        code, different, sums, bounds = unpacked(kind, t)
        _, order = blocks_of(kind, 0, different, sums, fine, fine)
        ids = np.full(len(different), -1, np.int64)
        for local, got in zip(back.column("local").to_pylist(), back.column("ids").to_pylist()):
            ids[order[C.unpack(local, np.uint32).astype(np.int64) - 1]] = C.unpack(got).view(np.int64)
        return rows_of(FOUND, found_rows(t, code, bounds, ids))

    met = C.checkpointed(rows.groupBy("task").applyInArrow(gather, BLOCKS).groupBy("bucket").applyInArrow(names(kind, least), FOUND))
    dealt = rows.groupBy("task").cogroup(met.where("chunk is not null").withColumnRenamed("chunk", "task").groupBy("task")).applyInArrow(deal, FOUND)
    return dealt.unionByName(met.where("chunk is null"))


def wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, cover: int = COVER) -> DataFrame:
    """All phrases of 2 to longest words that occur least times or more in their language: (lang, phrase, words, a, l, r, cut,
    score, covered, dropped, n).

    Texts are lower-cased (A-Z) and cut at sentence marks and line ends into pieces and at spaces and tabs into words;
    a counts a phrase within pieces, overlaps included, n the language's words. cut: after how many words its parts, of
    counts l and r, give the lowest score floor(2000000 a / (l + r)); equal ones go to the smallest. covered: the greatest
    count of a longer phrase that holds it; dropped: whether 100 * covered >= cover * a.

    Every part of a frequent phrase is frequent. So level k pairs neighbouring names of frequent (k-1)-word phrases, counts
    the pairs and names the frequent ones; a name's two parents are its first and its last k-1 words, from which the parts'
    counts and the phrases that cover it follow. Texts become chunks of about CHUNK_WORDS words where they are read, and a
    chunk sends each of its words or pairs once, in packed blocks by hash; a bucket sums and names them, and each chunk gets
    back where its frequent ones are. So no task sees more than a chunk, or a bucket's share of the distinct keys of each
    chunk, however common a word or a pair is. Each level is written to the shared folder.

    Null texts are empty, null languages are "und", repeated rows count each; empty tables, and those without a frequent
    word, give no rows; further columns may have any name.
    """
    spark, base = docs.sparkSession, scratch(docs.sparkSession, "phrases")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    plain = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    size = C.text_bytes(plain, "text")
    fine = max(C.partitions(spark), size // BUCKET_BYTES + 1)
    coarse = fine if fine * (size // (4 * CHUNK_WORDS) + 1) <= MOST_BLOCKS else math.isqrt(fine - 1) + 1
    fine = coarse * -(-fine // coarse)
    chunks = written(plain.mapInArrow(word_chunks(fine, coarse), BLOCKS), "chunks-1")
    totals = C.checkpointed(chunks.where(F.col("bucket") == WORDS).groupBy("lang").agg(F.sum("words").alias("n")))
    levels: list[DataFrame] = []
    for words in range(1, longest + 1):
        found = written(named(chunks.where("bucket >= 0").drop("lang", "words"), Words if words == 1 else Pairs, least, fine, coarse), f"names-{words}")
        heads = found.where("chunk is null")
        if words == 1:
            key = F.split_part("word", F.lit("\t"), F.lit(1))
            heads = heads.select("id", F.from_json(F.concat(F.lit('{"x":'), key, F.lit("}")), "x string")["x"].alias("lang"), F.substring_index("word", "\t", -1).alias("word"), "a")
            level = heads.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.array("a").alias("pre"), F.array("a").alias("suf"))
        else:
            heads = heads.select("id", "left", "right", "a")
            first = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"), F.col("pre").alias("before"))
            rest = levels[-1].select(F.col("id").alias("right"), "last", F.col("suf").alias("behind"))
            level = heads.join(first, "left").join(rest, "right").select("id", "left", "right", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "a", F.concat("before", F.array("a")).alias("pre"), F.concat("behind", F.array("a")).alias("suf"))
        levels.append(C.checkpointed(level))
        if words < longest:
            places = chunks.where(F.col("bucket") == PLACES).select("chunk", "a").groupBy("chunk")
            pairs = places.cogroup(found.where("chunk is not null").select("chunk", "local", "ids").groupBy("chunk")).applyInArrow(pair_chunks(fine, coarse, words + 1 == longest), BLOCKS)
            chunks = written(pairs, f"chunks-{words + 1}")
            for name in (f"chunks-{words}", f"names-{words}"):  # all that a later level needs is in what was just written
                C.remove(spark, f"{base}/{name}")
    C.remove(spark, base)
    out = [scored(level, levels[k + 1] if k + 1 < longest else None, k + 1) for k, level in enumerate(levels) if k]
    everything = out[0]
    for level in out[1:]:
        everything = everything.unionByName(level)
    dropped = F.lit(100).cast("decimal(3,0)") * wide("covered") >= F.lit(cover).cast("decimal(3,0)") * wide("a")
    return everything.withColumn("dropped", F.coalesce(dropped, F.lit(False))).join(totals, "lang")


def scored(level: DataFrame, longer: DataFrame | None, size: int) -> DataFrame:
    """Best cut and greatest covering count of the phrases of one size. A phrase in a longer one lies in one of a word more,
    whose parent it is, and whose count is no less."""
    cuts = []
    for k in range(1, size):
        left, right = F.col("pre")[k - 1], F.col("suf")[size - k - 1]
        score = F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(pre[{k - 1}] as decimal(20,0)) + cast(suf[{size - k - 1}] as decimal(20,0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r")))
    best = F.array_min(F.array(*cuts))
    out = level.withColumn("best", best)
    if longer is None:
        out = out.withColumn("covered", F.lit(None).cast("long"))
    else:
        over = longer.select(F.col("left").alias("id"), F.col("a").alias("covered")).unionByName(longer.select(F.col("right").alias("id"), F.col("a").alias("covered")))
        out = out.join(over.groupBy("id").agg(F.max("covered").alias("covered")), "id", "left")
    return out.select("lang", "phrase", F.lit(size).alias("words"), "a", "best.l", "best.r", "best.cut", "best.score", "covered")


def top_phrases(found: DataFrame, most: int = MOST) -> DataFrame:
    """The first most phrases of each language that are not dropped, ranked by score, count, and the phrase's bytes. Slices of
    a language are ranked first, so the last ranking sees at most slices times most rows of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = found.where(~F.col("dropped")).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SLICES)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= most)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_phrases(phrases(C.table(spark, sf_dir, "documents")))


OP12_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[s : s + k - 1], ' ') AS phrase, count(*)::BIGINT AS a
      FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k), unnest(range(1, len(ws) - k + 2)) AS u(s) GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE a >= {LEAST}),
c AS (SELECT f.lang, f.phrase, f.a, l.a AS l, r.a AS r, (2000000::HUGEINT * f.a // (l.a + r.a))::BIGINT AS score, j
      FROM f, unnest(range(1, f.k)) AS u(j) JOIN f l ON l.lang = f.lang AND l.phrase = array_to_string(f.ws[1 : j], ' ') JOIN f r ON r.lang = f.lang AND r.phrase = array_to_string(f.ws[j + 1 :], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT lang, array_to_string(ws[s : s + m - 1], ' ') AS phrase, max(a) AS covered FROM f, unnest(range(2, f.k)) AS v(m), unnest(range(1, f.k - m + 2)) AS u(s) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE coalesce(100::HUGEINT * covered < {COVER}::HUGEINT * a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {MOST}
"""
