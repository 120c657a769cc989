import math
import random

from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from sievework.llm.unigram import Counter, count_tokens, model_path, op6, vocabulary


def with_bytes(pieces):
    """The library takes byte pieces from the vocabulary itself; as no text here has their names, they match nothing else."""
    return [*pieces, *((f"<0x{b:02X}>", 0.0) for b in range(256))]


def reference(pieces, unk, bytes_=False):
    t = Tokenizer(models.Unigram(with_bytes(pieces) if bytes_ else pieces, unk_id=unk, byte_fallback=bytes_))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_same_as_the_tokenizers_library(spark, docs, rows, no_docs):
    pieces, unk, bytes_ = vocabulary(model_path())
    ref = reference(pieces, unk, bytes_)
    odd = ["日本語 x\ny", "  two  spaces ", "☃☃☃ ☃a☃", "▁▁ a▁b", "x" * 500, "\t\n", "été ß"]
    counter = Counter(pieces, unk, byte_fallback=bytes_)
    for t in odd + [r[1] for r in rows if r[1]]:
        assert counter.count(t)[0] == len(ref.encode(t).ids), t
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs.withColumn("n_tokens", docs.lang), model_path()).collect()}
    assert got == {r[0]: len(ref.encode(r[1]).ids) if r[1] else 0 for r in rows}
    assert count_tokens(no_docs, model_path()).collect() == []
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert [counter.count(t)[0] for t in real] == [len(ref.encode(t).ids) for t in real]


def test_ties():
    r = random.Random(4)
    for _ in range(40):
        pieces = [("<unk>", 0.0), ("▁", -2.0)] + [(p, float(-r.randrange(1, 4))) for p in {"".join(r.choice("abc") for _ in range(r.randrange(1, 4))) for _ in range(12)}]
        ref, counter = reference(pieces, 0), Counter(pieces, 0)
        for _ in range(30):
            t = "".join(r.choice("abcd ") for _ in range(r.randrange(1, 20)))
            assert counter.count(t)[0] == len(ref.encode(t).ids), (pieces, t)


def unsplit(pieces, unk, bytes_=False):
    t = Tokenizer(models.Unigram(with_bytes(pieces) if bytes_ else pieces, unk_id=unk, byte_fallback=bytes_))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return t


def test_whole_vocabulary_same_as_the_library_without_the_split(spark, rows):
    pieces, unk, bytes_ = vocabulary(model_path())
    ref, counter, score = unsplit(pieces, unk, bytes_), Counter(pieces, unk, False, bytes_), dict(pieces)
    odd = ["a  b", "a ", " a", "x" + " " * 16 + "y", "x" + " " * 100, "def f():\n        return  1", "  two  spaces ", "☃☃☃  ☃a☃", "▁▁ a▁b", "日本語   x"]
    for t in odd + [r[1] for r in rows if r[1]]:
        assert counter.count(t)[0] == len(ref.encode(t).ids), t
        if "☃" not in t and all(x in score for x in ref.encode(t).tokens):
            assert abs(counter.count(t)[1] - sum(score[x] for x in ref.encode(t).tokens)) < 1e-6, t
    assert counter.count("x" + " " * 16 + "y")[0] <= 4 and counter.count("hello world")[0] == 3
    assert counter.count("hello ☃")[0] == len(ref.encode("hello ☃").ids) and -100 < counter.count("hello ☃")[1] < -30 and counter.count("𓀀𓀀")[0] == 1 + 8 == len(ref.encode("𓀀𓀀").ids)
    assert math.isclose(math.fsum(math.exp(s) for _, s in pieces[1:]), 1)
    at = "/root/testdata/sf0.001"
    got = {r.doc_id: r.n_tokens for r in op6(spark, at).collect()}
    assert got == {r.doc_id: len(ref.encode(r.text).ids) if r.text else 0 for r in spark.read.parquet(f"{at}/documents.parquet").collect()}


def test_whole_vocabulary_ties_and_pieces_across():
    r = random.Random(5)
    for k in range(40):
        letters = "abc▁" if k % 2 else "abc"
        pieces = [("<unk>", 0.0), ("▁", -2.0), ("▁▁", -3.0)] + [(p, float(-r.randrange(1, 4))) for p in {"".join(r.choice(letters) for _ in range(r.randrange(1, 4))) for _ in range(12)} - {"▁", "▁▁"}]
        ref, counter = unsplit(pieces, 0), Counter(pieces, 0, split=False)
        for _ in range(30):
            t = "".join(r.choice("abcd  ") for _ in range(r.randrange(1, 20)))
            assert counter.count(t)[0] == len(ref.encode(t).ids), (pieces, t)


def test_repeated_rows_and_other_columns(spark, docs):
    more = docs.union(docs).withColumns({c: F.lit(c) for c in ("a.b", "token_score", "segment")})
    out = count_tokens(more, model_path(), split=False)
    assert out.columns == [c for c in more.columns if c != "token_score"] + ["n_tokens", "token_score"]
    n = {}
    for r in out.collect():
        n.setdefault(r.doc_id, []).append(r.n_tokens)
    assert all(len(v) == 2 and v[0] == v[1] for v in n.values())


def test_near_the_public_tokenizer(spark):
    """The merge model itself, whose vocabulary this is: how far counts are from its own, per text and in all."""
    import sentencepiece

    model, counter = sentencepiece.SentencePieceProcessor(model_file=model_path()), Counter(*vocabulary(model_path())[:2], False, True)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    own = [counter.count(t)[0] for t in texts]
    its = [len(model.encode(t)) for t in texts]
    apart = [abs(a - b) / b for a, b in zip(own, its)]
    print(sum(own) / sum(its), sum(apart) / len(apart), max(apart))
    assert abs(sum(own) / sum(its) - 1) < 0.1
