import random
import time
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sievework.llm.components import connected_components
from sievework.llm.simhash import block_links, fingerprint, forest, near_dedup, simhash_groups


def plain(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, ids, d=4):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    low = {}
    for i in range(len(fps)):
        low[find(i)] = min(low.get(find(i), 2**70), ids[i])
    return [low[find(i)] for i in range(len(fps))]


def test_same_as_brute_force(docs, rows):
    fps = [plain(r[1]) for r in rows]
    assert fps == [fingerprint(r[1]) for r in rows]
    comp = groups(fps, [2**63 - 1 if r[0] is None else r[0] for r in rows])
    want = sorted(((r[0], f, None if c == 2**63 - 1 else c) for r, f, c in zip(rows, fps, comp)), key=str)
    got = sorted(((r.doc_id, r.fp % 2**64, r.component) for r in simhash_groups(docs).collect()), key=str)
    assert got == want and any(c != i for i, _, c in want)


def test_blocks_join_what_all_pairs_join():
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(40)]
    fp = [b ^ sum({1 << r.randrange(64) for _ in range(r.randrange(4))}) for b in base for _ in range(12)] + [base[0] ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i)]
    fp = sorted(set(fp))
    code = np.array(fp, np.uint64)
    a, b = block_links(np.zeros(len(fp), int), code[:, None], 4)
    assert all((fp[x] ^ fp[y]).bit_count() <= 4 for x, y in zip(a, b))
    node, low = forest(code[a], code[b])
    label = dict(zip(node.tolist(), low.tolist()))
    assert [label.get(x, x) for x in fp] == groups(fp, fp)
    k = np.repeat(np.arange(len(fp) // 50 + 1), 50)[: len(fp)]
    a, b = block_links(k, code[:, None], 4)
    label = dict(zip(*(x.tolist() for x in forest(code[a], code[b]))))
    for i in range(k[-1] + 1):
        part = [x for x, y in zip(fp, k) if y == i]
        assert [label.get(x, x) for x in part] == groups(part, part)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (105, 101), (7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 105: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rounds_leave_no_shuffles_behind(spark):
    """Of the shuffles of each round only the count of what is left stays: the others' files go with its checkpoint."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    shuffles = lambda: {f.name.split("_")[1] for at in folders for f in Path(at.getPath()).rglob("shuffle_*_*")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(key)
    got = connected_components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"))
    for _ in range(50):  # files go in the background
        if len(new := shuffles() - before) <= 8:
            break
        time.sleep(0.2)
    assert len(new) <= 8 and spark.conf.get(key) == was
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(61)}


def jaccard(a, b, n=5):
    s = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (a.lower().split(), b.lower().split())]
    return len(s[0] & s[1]) / len(s[0] | s[1])


def test_near_dedup(spark, docs, no_docs):
    r = random.Random(9)
    vocab = [f"t{i}" for i in range(3000)]
    base = [[r.choice(vocab) for _ in range(r.choice([60, 200, 500]))] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for i, b in enumerate(base[:40]):
        c = list(b)
        for _ in range(max(1, len(c) // 70)):
            c[r.randrange(len(c))] = "changed"
        texts.append(" ".join(c))
        texts.append(" ".join(b[: len(b) // 2] + [r.choice(vocab) for _ in range(len(b) // 2)]))
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in near_dedup(df).collect()}
    near = [(i, jaccard(texts[i], texts[(i - 60) // 2])) for i in range(60, len(texts), 2)]
    sure = [i for i, j in near if j >= 0.8]
    assert len(sure) >= 20 and sum(i in kept for i in sure) <= len(sure) // 20
    far = [i for i in range(61, len(texts), 2)]
    assert kept >= set(range(60)) | set(far)
    got = near_dedup(docs)
    assert got.columns == docs.columns
    kept = {r.doc_id for r in got.collect()}
    assert 1000 in kept or any(not (t or "").split() for t in [r.text for r in got.collect()])
    assert near_dedup(no_docs).collect() == [] and simhash_groups(no_docs).collect() == []


def test_near_dedup_links_are_verified(spark, docs):
    """Pairs on both sides of 0.8, a chain below it, and repeats that the counters of a SimHash would count."""
    r = random.Random(21)
    word = lambda: f"v{r.randrange(10**6)}"
    texts = []
    for i in range(240):
        base = [word() for _ in range(300)]
        # k changed words, far apart, change 5k of 296 shingles
        other, k = list(base), (5, 6, 8, 10)[i % 4]
        for j in range(k):
            other[10 + j * (280 // k)] = word()
        texts += [" ".join(base), " ".join(other)]
    phrase = " ".join(word() for _ in range(10))
    texts += [" ".join(word() for _ in range(200)) + (" " + phrase) * 100 for _ in range(2)]
    once = " ".join(word() for _ in range(40))
    texts += [once + " " + once + " " + once, once + " " + once]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], docs.schema)
    kept = {x.doc_id for x in near_dedup(df).collect()}
    like = [jaccard(texts[i], texts[i + 1]) for i in range(0, len(texts), 2)]
    assert {2 * i for i in range(len(like))} <= kept
    assert all(2 * i + 1 in kept for i, j in enumerate(like) if j < 0.8)
    assert sum(0.65 < j < 0.8 for j in like) >= 100
    near = [2 * i + 1 in kept for i, j in enumerate(like) if j >= 0.8]
    assert len(near) >= 120 and sum(near) <= 2
    assert len(texts) - 1 not in kept


def test_large_blocks_are_dealt_again(spark, monkeypatch):
    """One segment value that all fingerprints share, and blocks far beyond the bound: same links."""
    from sievework.llm import simhash as S

    monkeypatch.setattr(S, "BLOCK_ROWS", 20)
    r = random.Random(5)
    base = [r.getrandbits(40) << 24 for _ in range(60)]
    fp = sorted({b ^ sum({1 << r.randrange(64) for _ in range(r.randrange(4))}) for b in base for _ in range(8)})
    signed = lambda x: x - 2**64 if x >> 63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in fp], "fp long")
    links = [(x.a % 2**64, x.b % 2**64) for x in S.pivot_links(nodes, 4).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    node, low = forest(np.array([a for a, _ in links], np.uint64), np.array([b for _, b in links], np.uint64))
    label = dict(zip(node.tolist(), low.tolist()))
    assert [label.get(x, x) for x in fp] == groups(fp, fp)


def test_repeated_rows_hot_fingerprints_and_clashing_columns(spark, docs, rows):
    from sievework.llm import simhash as S

    twice = docs.union(docs).withColumns({c: F.lit(c) for c in ("fp", "id", "component", "low", "n", "node", "a.b", "row")})
    one = {(r.doc_id, r.fp, r.component) for r in simhash_groups(docs).collect()}
    got = [(r.doc_id, r.fp, r.component) for r in simhash_groups(twice).collect()]
    assert set(got) == one and len(got) == 2 * len(rows)
    many = spark.createDataFrame([(i, "one text that many rows have", "en", "a", 1) for i in range(2500)] + [(5000 + i, f"other {i} text", "en", "a", 1) for i in range(50)], docs.schema)
    out = simhash_groups(many).where("doc_id < 5000").collect()
    assert len(out) == 2500 and {r.component for r in out} == {0} and len({r.fp for r in out}) == 1
    kept = near_dedup(twice)
    assert kept.columns == twice.columns and {r["a.b"] for r in kept.collect()} == {"a.b"}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in near_dedup(docs).collect()}


def test_near_copies_of_one_text_in_slices(spark, docs, monkeypatch):
    """A spectrum of edits of one text, whose outer members link through others only: as by brute force, in one slice or many."""
    from sievework.llm import simhash as S

    r = random.Random(31)
    base = [f"v{r.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(150)] = f"v{r.randrange(10**6)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], docs.schema)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    for size in (1 << 20, 3000):
        monkeypatch.setattr(S, "SLICE_SHINGLES", size)
        got = {x.doc_id: x.component for x in S.similar_groups(df, "doc_id", "text").collect()}
        assert sum(got[i] != label[i] for i in got) <= 3 and len(set(label)) > 3
