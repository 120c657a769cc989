import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sievework.llm import token_store as T


def test_round_trip(spark, docs, rows, tmp_path):
    path = f"file://{tmp_path}/t"
    T.write_tokens(docs.withColumn("part", docs.lang), path, T.tokenizer_path())
    tok = Tokenizer.from_file(T.tokenizer_path())
    start, want = 0, {}
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, list(r.ids)) for r in T.read_tokens(spark, path).collect()}
    assert got == want
    r = spark.read.parquet(f"{path}/blocks").first()
    first = T.Block(bytes(r.block), bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary))
    assert T.read_document(spark, path, r.part, r.number, len(first) - 1) == want[first.doc_ids[-1] if first.doc_ids[-1] < 2**62 else None][3]


def test_pieces_encode_as_whole_texts(rows):
    enc = T.Encoder(T.tokenizer_path())
    odd = ["  a  b\n c", "a b ", " lead", "x <|endoftext|> y", "", " ", "it's 's  don't", "a ,. b,'s c!? ß", "x\u001c y z\u0085 q", "1 22 3a a3 ,,   é", "日本 語 é x"]
    for t in odd + [r[1] or "" for r in rows]:
        assert np.frombuffer(enc.ids(t), enc.kind).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def test_slices_of_odd_texts_encode_as_whole_texts():
    r = random.Random(3)
    parts = [" "] * 9 + ["\n"] * 3 + list("aZ09.,!'#(<|\t\r\0\x1c\x85\xa0\xad\u2003éß×ſƀĠĊĀ日²٣\u0301🙂") + ["'s", "don't", "  ", "\n\n", " \n", "\r\n", "the", "Über", "<|endoftext|>"]
    texts = ["".join(r.choices(parts, k=k % 40)) for k in range(2000)] + [None, "", "a" * 70 + ".", "b " * 5000]
    enc = T.Encoder(T.tokenizer_path())
    want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for bound in (3000, 10):
        enc.bound = bound
        assert [np.frombuffer(x, enc.kind).tolist() for x in enc.all_ids(texts)] == want
        assert len(enc) <= 3000
        enc.clear()


def test_a_word_is_encoded_once_wherever_it_stands():
    r = random.Random(4)
    words = ["".join(r.choices("abcdefgh", k=9)) for _ in range(40)]
    texts = ["".join(w + r.choice([" ", " ", ", ", "\n", ".\n"]) for w in r.choices(words, k=30)) + "end" for _ in range(200)]
    enc, calls = T.Encoder(T.tokenizer_path()), []
    enc.model, model = lambda x: calls.append(x) or model(x), enc.model
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(enc.ids(t), enc.kind).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids
    assert len(calls) <= 3 * 41 + 2  # after a space, and after a break with the break itself; two marks


def test_empty_and_damaged(spark, no_docs, tmp_path):
    T.write_tokens(no_docs, f"file://{tmp_path}/e", T.tokenizer_path())
    assert T.read_tokens(spark, f"file://{tmp_path}/e").collect() == []
    with pytest.raises(ValueError):
        T.Block(T.write_block([1], [b"\1\0"], 2, b""), b"other")
    assert T.train_dictionary([]) == b""


def test_sample_is_of_all_rows(spark):
    from sievework.llm.token_store import sampled

    df = spark.range(2000).selectExpr("id", "repeat('x ', 10) AS text").coalesce(1)
    got = {r.id for r in sampled(df, 100).collect()}
    assert len(got) == 100 and min(got) < 200 and max(got) >= 1800
    assert got == {r.id for r in sampled(df.repartition(7), 100).collect()}
