"""Token ids in binary blocks with a shared zstandard dictionary (operator 4)."""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from codecs import charmap_decode
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.llm import common as C

MAGIC = b"TOKB0001"
#: magic, bytes of an id, documents, id of the block's dictionary (first 16 bytes of its sha256)
HEADER = struct.Struct("<8sII16s")
BLOCK_DOCS = 2048
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
#: Letters, digits and marks (no apostrophe), for which the byte-level pattern is the short one below.
_PLAIN = re.compile(f"\n?[!-&(-~{_LATIN}]+")
_MATCH = re.compile(f" ?[{_LATIN}]+| ?[0-9]+| ?[!-&(-/:-@[-`{{-~]+|\n")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_BEFORE_MARKS = re.compile(f"[0-9{_LATIN}]")


def slices(texts, most: int):
    """Lists of texts of about most characters together, in order; a longer text is one by itself or the last of one."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def runs(table: np.ndarray, first: np.ndarray, size: np.ndarray) -> bytes:
    """The stretches of table that begin at first and have size values, one after another."""
    ends = np.cumsum(size)
    return table[np.repeat(first - ends + size, size) + np.arange(size.sum())].tobytes()


class Encoder(dict):
    """Packed ids of text pieces, by the tokenizers library; pieces met once are kept, up to a bound.

    Byte-level BPE first splits a text by a pattern whose every match of a space between two other characters begins
    there, and a line break between two is a match by itself, so a text cut before such spaces and breaks encodes piece by
    piece to the same ids. Keys are what stands after a space, or a break and what stands after it; the start of a text is
    looked up as if after a break. A slice of texts looks each distinct piece up once. Of what is new, all plain pieces are
    split into matches together, all others by the tokenizer's own pre-tokenizer, so that a piece begins with each match
    that begins with a space or break; the matches go through the tokenizer's model. Marks after a letter or digit are a
    match by themselves, so such a piece is put together. A text that has the string of a special token is encoded whole.
    """

    bound = 1 << 19

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split, self.model = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        letter = lambda c: spell.pre_tokenize_str(chr(c))[0][0]
        #: How the library spells each byte up to those that lead U+07FF; byte 0 parts the matches.
        self.spelled = "".join(["\0", *map(letter, range(1, 0x80)), *(letter(b)[1] for b in range(0x80, 0xC0)), "\ufffe" * 2, *(letter((b & 31) << 6)[0] for b in range(0xC2, 0xE0))])
        self.starts = (letter(32), letter(10))
        self.line_break = len(self.encode_piece("\n"))
        self.marks = lru_cache(1 << 16)(lambda x: self.packed_ids([t.id for t in self.model(x)]))

    def packed_ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode_piece(self, piece: str) -> bytes:
        return self.packed_ids([t.id for x, _ in self.split(piece) for t in self.model(x)])

    def encode_key(self, key: str) -> bytes:
        return self.encode_piece(key if key[0] == "\n" else " " + key)

    def encode_keys(self, keys: list[str], plain: bool) -> list[bytes]:
        """Of keys without spaces and breaks but at the start, all of them plain ones or none."""
        text = (" " + " ".join(keys)).replace(" \n", "\n")
        if plain:
            matches = charmap_decode("\0".join(_MATCH.findall(text)).encode(), "strict", self.spelled)[0].split("\0")
        else:
            matches = [x for x, _ in self.split(text)]
        ids, cuts, model, starts = [], [], self.model, self.starts
        for x in matches:
            if x[0] in starts:
                cuts.append(len(ids))
            ids += [t.id for t in model(x)]
        data, cuts = self.packed_ids(ids), [*(self.width * c for c in cuts), len(ids) * self.width]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def learned(self, new: list[str]) -> dict[str, bytes]:
        """Ids of new pieces, and of what stands before their marks; kept if short and within the bound."""
        plain, others, marked, found = [], [], [], {}
        for piece in new:
            stem = piece.rstrip(_MARKS) if piece[-1] in _MARKS else piece
            if 0 < len(piece) - len(stem) < 64 and _BEFORE_MARKS.match(stem[-1:]):
                marked.append(piece)
                found[piece] = stem
                piece = stem
                if stem in self or stem in found:
                    continue
            if piece not in found:
                found[piece] = b""
                (plain if _PLAIN.fullmatch(piece) else others).append(piece)
        apart = {k for k in others if " " in k or "\n" in k[1:] or k[-1].isspace()}
        found.update((k, self.encode_key(k)) for k in apart)
        for keys, kind in ((plain, True), ([k for k in others if k not in apart], False)):
            for part in slices(keys, 1 << 18):
                found.update(zip(part, self.encode_keys(part, kind)))
        for piece in marked:
            stem = found[piece]
            found[piece] = (self[stem] if stem in self else found[stem]) + self.marks(piece[len(stem) :])
        self.update(islice(((k, x) for k, x in found.items() if len(k) < 64), max(0, self.bound - len(self))))
        return found

    def cut(self, text: str) -> tuple[bytes, list[str] | str]:
        """(start, pieces): the text's ids are start and those of its pieces. Where each space and break is a cut, pieces is
        one string, to be cut at spaces, and its first break is not the text's."""
        if any(s in text for s in self.special):
            return self.packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids), []
        if not text:
            return b"", []
        lines = text.replace("\n", " \n")
        wide = "  " in lines or "\n " in lines or not text.replace("\n", "").isprintable() and _WIDE.search(text)  # no other space is printable
        if wide or text[0].isspace() or text[-1].isspace():
            first, *pieces = _LONE_SPACE.split(text)
            return self.encode_piece(first), pieces
        return b"", "\n" + lines

    def slice_ids(self, texts: list[str]) -> list[bytes]:
        out = [self.cut(t) for t in texts]
        plain = [k for k, (_, pieces) in enumerate(out) if isinstance(pieces, str)]
        rest = [k for k, (_, pieces) in enumerate(out) if isinstance(pieces, list)]
        lists = pc.split_pattern(pa.array([out[k][1] for k in plain], pa.large_string()), " ")
        pieces = pa.concat_arrays([lists.flatten(), pa.array([x for k in rest for x in out[k][1]], pa.large_string())]).dictionary_encode()
        words, at = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        found = list(map(self.get, words))
        gaps = [i for i, x in enumerate(found) if x is None]
        fresh = self.learned([words[i] for i in gaps])
        for i in gaps:
            found[i] = fresh[words[i]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        firsts, table = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), self.kind)
        ids = b"".join([runs(table, firsts[x], sizes[x]) for x in np.split(at, range(1 << 18, len(at), 1 << 18))])
        ends = np.append(0, np.cumsum(sizes[at])) * self.width
        cuts = ends[np.cumsum([0, *pc.list_value_length(lists).to_pylist(), *(len(out[k][1]) for k in rest)])].tolist()
        skip = [self.line_break] * len(plain) + [0] * len(rest)
        packed = {k: out[k][0] + ids[a + s : b] for k, a, b, s in zip(plain + rest, cuts, cuts[1:], skip)}
        return [packed[k] for k in range(len(texts))]

    def all_ids(self, texts):
        """The packed ids of each text, in order, a slice of about four million characters at a time."""
        for part in slices((t or "" for t in texts), 1 << 22):
            yield from self.slice_ids(part)

    def ids(self, text: str | None) -> bytes:
        return self.slice_ids([text or ""])[0]


def encoder(path: str) -> Encoder:
    return C.worker_cache(("encoder", path), lambda: Encoder(path))


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A zstandard dictionary of serialized id arrays. What is too little to train on is one as it is (the library takes
    plain content too); no samples give none."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


def write_block(doc_ids: list[int], arrays: list[bytes], width: int, dictionary: bytes, level: int = 3) -> bytes:
    """One block: header, doc ids, running token counts and frame offsets (64-bit each), then one frame a document."""
    packer = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=False, **_dictionary(dictionary))
    frames = [packer.compress(a) for a in arrays]
    offsets = np.cumsum([0, *map(len, frames)], dtype="<i8")
    tokens = np.cumsum([0, *(len(a) // width for a in arrays)], dtype="<i8")
    head = HEADER.pack(MAGIC, width, len(frames), hashlib.sha256(dictionary).digest()[:16])
    return b"".join([head, np.array(doc_ids, "<i8").tobytes(), tokens.tobytes(), offsets.tobytes(), *frames])


class Block:
    """Reads a block; document(k) decompresses that document alone."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, n, key = HEADER.unpack_from(data)
        if magic != MAGIC or key != hashlib.sha256(dictionary).digest()[:16]:
            raise ValueError("not a token block, or one of another dictionary")
        self.data, at = data, HEADER.size
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.tokens = np.frombuffer(data, "<i8", n + 1, at + 8 * n)
        self.offsets = np.frombuffer(data, "<i8", n + 1, at + 8 * (2 * n + 1))
        self.base = at + 8 * (3 * n + 2)
        self.unpacker = zstandard.ZstdDecompressor(**_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.doc_ids)

    def document(self, k: int) -> np.ndarray:
        a, b = self.base + int(self.offsets[k]), self.base + int(self.offsets[k + 1])
        return np.frombuffer(self.unpacker.decompress(self.data[a:b]), f"<u{self.width}")


def sampled(plain: DataFrame, count: int) -> DataFrame:
    """The rows (id, text) of the count least hashes of id and text among all rows, whole, each of equal ones once. Hashes
    alone are ordered; texts are read again for those that are not above the last of them."""
    h = F.xxhash64("id", "text")
    last = plain.select(h.alias("h")).orderBy("h").limit(count).agg(F.max("h").alias("h")).first().h
    return plain.where(h <= F.lit(last if last is not None else 0)).dropDuplicates(["id", "text"])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, sample_docs: int = 400) -> None:
    """Write each whole text's ids, then end_id, in ascending id order (nulls last) as blocks under path.

    path/dictionary has the shared dictionary, trained on the serialized ids of a bounded sample (the sample_docs documents
    of least hash of id and text among all rows, equal ones once: it decides sizes, never contents); path/blocks has the blocks, numbered in
    order. Spark's own committer writes both, so a lost executor's task is run again and leaves nothing half done. Null
    texts are empty: the end id alone. Rows of equal or no ids stay, next to each other, by a hash of the text, which
    deals them out as well. Other columns are not read. An empty table gives no blocks.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(C.NO_ID)).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def sample(batches):
        enc = encoder(tokenizer_path)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"ids": pa.array(list(enc.all_ids(x for x in C.values(batch.column("text")) if x)), pa.binary())})

    dictionary = train_dictionary([bytes(r.ids) for r in sampled(plain, sample_docs).mapInArrow(sample, "ids binary").collect()])
    spark.range(1, numPartitions=1).select(F.lit(dictionary).alias("dictionary")).write.mode("overwrite").parquet(f"{path}/dictionary")
    parts = max(C.partitions(spark), C.text_bytes(docs, text_col) // (28 << 20) + 1)

    def run(batches):
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.kind).tobytes()
        ids, arrays, held = [], [], 0

        def block():
            data = write_block(ids, arrays, enc.width, dictionary)
            n = sum(map(len, arrays)) // enc.width
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "n_docs": pa.array([len(ids)], pa.int32()), "n_tokens": pa.array([n], pa.int64()), "block": pa.array([data], pa.binary())})

        part = number = 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for k, packed in zip(batch.column("id").to_pylist(), enc.all_ids(C.values(batch.column("text")))):
                ids.append(k)
                arrays.append(packed + end)
                held += len(arrays[-1])
                if len(ids) >= BLOCK_DOCS or held > 8 << 20:
                    yield block()
                    number, ids, arrays, held = number + 1, [], [], 0
        if ids:
            yield block()
        C.give_back()

    ordered = plain.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie").select(F.spark_partition_id().alias("part"), "id", "text")
    with C.text_batches(spark):
        ordered.mapInArrow(run, "part int, number int, n_docs int, n_tokens long, block binary").write.mode("overwrite").parquet(f"{path}/blocks")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per block: part, number, and first: the ids in all blocks before it. One row per block of up to BLOCK_DOCS documents:
    parts are summed first, so only one row per part meets in the running sum over parts."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "number", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select("part", "number", (F.col("base") + F.col("inner")).alias("first"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document, read back from the blocks: doc_id, start, n_tokens, ids_crc32 and (with_ids) its ids."""
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)

    def run(batches):
        for batch in batches:
            for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "block"))):
                block = Block(data, dictionary)
                ids, crc = [], []
                for k in range(len(block)):
                    x = block.document(k).astype("<u4")
                    crc.append(zlib.crc32(x.tobytes()))
                    if with_ids:
                        ids.append(x)
                n = len(block)
                cols = {"part": pa.array([part] * n, pa.int32()), "number": pa.array([number] * n, pa.int32()), "doc_id": pa.array(block.doc_ids), "inner": pa.array(block.tokens[:-1]), "n_tokens": pa.array(np.diff(block.tokens)), "ids_crc32": pa.array(crc, pa.int64())}
                yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(ids, pa.list_(pa.int64()))} if with_ids else {}))

    schema = "part int, number int, doc_id long, inner long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    docs = spark.read.parquet(f"{path}/blocks").select("part", "number", "block").mapInArrow(run, schema)
    out = docs.join(read_index(spark, path), ["part", "number"])
    return out.select(C.public_id("doc_id").alias("doc_id"), (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * with_ids))


def read_document(spark: SparkSession, path: str, part: int, number: int, k: int) -> list[int]:
    """One document's ids from its place: one block is read and one frame decompressed."""
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    row = spark.read.parquet(f"{path}/blocks").where((F.col("part") == part) & (F.col("number") == number)).first()
    return Block(bytes(row.block), dictionary).document(k).tolist()


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digest(docs: DataFrame) -> DataFrame:
    """Write docs as blocks into the shared folder, and read the digest of each document back from them."""
    spark = docs.sparkSession
    path = f"{C.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer_path())
    return read_tokens(spark, path, with_ids=False)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(C.table(spark, sf_dir, "documents"))
