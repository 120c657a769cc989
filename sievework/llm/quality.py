"""Quality classifier with host and path posteriors by hierarchical empirical Bayes (operator 3)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm import common as C
from sievework.llm.decontaminate import words

#: The classifier is fitted on about this many labelled rows, whatever the size of the corpus; all rows are scored.
FIT_ROWS = 4000
VOCABULARY = 600
BINS = 8
#: Numbers that shape gives.
SHAPES = 8
#: Up to so many sites (some 100 bytes each) the posteriors are broadcast; beyond, rows and sites are joined by key.
BROADCAST_SITES = 50_000
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
#: ASCII marks other than those of plain prose.
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?_")


def shape(text: str | None, split: list[bytes]) -> list[float]:
    """Shares that do not depend on the language: repeated words and lines, symbols, capitals, digits, lengths."""
    t = text or ""
    raw = t.encode("utf-8", "surrogatepass")
    n, chars = max(1, len(split)), max(1, len(raw))
    of = lambda which: (len(raw) - len(raw.translate(None, which))) / chars
    lines = t.split("\n")
    letters = max(1, sum(map(len, split)))
    return [
        len(set(split)) / n,
        sum(map(bytes.__eq__, split, split[1:])) / n,
        of(_SYMBOLS),
        of(_CAPITALS),
        of(_DIGITS),
        letters / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(len(split))),
    ]


def marks(split) -> set[bytes]:
    """Distinct words, and their beginnings of 6 and 8 bytes, which gather the forms of one stem."""
    known = set(split)
    return known | {w[:6] + b"*" for w in known if len(w) >= 6} | {w[:8] + b"*" for w in known if len(w) >= 8}


class Logistic:
    """Logistic regression on quantile bins of shape shares and on the presence of words of a chosen vocabulary."""

    def __init__(self, vocabulary: dict[bytes, int], edges: np.ndarray, weights: np.ndarray, bias: float):
        self.vocabulary, self.edges, self.weights, self.bias = vocabulary, edges, weights, bias

    @staticmethod
    def bins(edges: np.ndarray, shares) -> list[int]:
        return [k * (BINS + 1) + int(np.searchsorted(edges[k], x)) for k, x in enumerate(shares)]

    @classmethod
    def fit(cls, vocabulary: list[bytes], shares: np.ndarray, y: np.ndarray, row: np.ndarray, word: np.ndarray, steps: int = 300, decay: float = 1e-3) -> Logistic:
        """shares and y (0 or 1) by row; row and word list which rows have which words of the vocabulary."""
        if not len(y):
            return cls({}, np.zeros((0, BINS)), np.zeros(0), 0.0)
        n, p, y = len(y), float(np.mean(y)), np.asarray(y, float)
        edges = np.quantile(shares, np.linspace(0, 1, BINS + 2)[1:-1], axis=0).T
        base = len(edges) * (BINS + 1)
        own = np.array([cls.bins(edges, x) for x in shares], np.int64).reshape(n, -1)
        col = np.concatenate([own.ravel(), base + word])
        row = np.concatenate([np.repeat(np.arange(n), own.shape[1]), row])
        weights, bias = np.zeros(base + len(vocabulary)), float(np.log((p + 1e-3) / (1 - p + 1e-3)))
        m, v, mb, vb = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
        for t in range(1, steps + 1):
            e = 1 / (1 + np.exp(-(np.bincount(row, weights[col], n) + bias))) - y
            g, gb = np.bincount(col, e[row], len(weights)) / n + decay * weights, e.mean()
            m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            weights = weights - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            bias -= 0.1 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
        return cls({w: i for i, w in enumerate(vocabulary)}, edges, weights, float(bias))

    def __call__(self, shares: list[float], split) -> float:
        if not len(self.weights):
            return 0.5
        base = len(self.edges) * (BINS + 1)
        at = self.bins(self.edges, shares) + [base + self.vocabulary[w] for w in self.vocabulary.keys() & split]
        return float(1 / (1 + np.exp(-np.clip(self.weights[at].sum() + self.bias, -30, 30))))


class Evidence:
    """P(good and not toxic) of a text alone."""

    def __init__(self, good: Logistic, toxic: Logistic):
        self.good, self.toxic = good, toxic

    def __call__(self, text: str | None) -> float:
        split = words(text)
        s, known = shape(text, split), marks(split)
        p = self.good(s, known)
        return p * (1 - self.toxic(s, known)) if len(self.toxic.weights) else p


def fit_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, rows: int) -> DataFrame:
    """(id, text, q, t): about rows labelled documents, chosen by a hash of the id. Of an id's several labels the largest
    count, of its several texts the least, so the sample stays bounded whatever repeats."""
    known = labels.where(F.col(f"`{label_id}`").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(f"`{label_id}`").cast("long").alias("id")).agg(F.max(F.col("quality").cast("int")).alias("q"), F.max(F.coalesce(F.col("toxic").cast("int"), F.lit(0))).alias("t"))
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return plain.join(F.broadcast(chosen), "id").groupBy("id", "q", "t").agg(F.min("text").alias("text"))


def telling_marks(marked: DataFrame, label: str, rows: int, positive: int) -> list[bytes]:
    """The VOCABULARY marks whose presence differs most between the labels, from (w, c, sum of the label): counted in Spark,
    so only the chosen ones reach the driver."""
    p = positive / max(rows, 1)
    z = F.abs(F.col(label) - F.col("c") * p) / F.sqrt(F.col("c") * max(p * (1 - p), 1e-9))
    top = marked.select("w", z.alias("z")).where("z > 4").orderBy(F.col("z").desc(), "w").limit(VOCABULARY)
    return [bytes(r.w) for r in top.collect()]


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, rows: int = FIT_ROWS) -> Evidence:
    """Fit both classifiers on a bounded sample of labelled documents. Words are counted and chosen by aggregation in Spark;
    what comes to the driver is shares and numbers of chosen words, a few kilobytes a sample row at most."""

    def read(batches):
        C.drop_caches()
        for batch in batches:
            out = [(shape(t, w), list(marks(w))) for t in batch.column("text").to_pylist() for w in [words(t)]]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "s": pa.array([x for x, _ in out], pa.list_(pa.float64())), "w": pa.array([x for _, x in out], pa.list_(pa.binary())), "q": batch.column("q"), "t": batch.column("t")})

    sample = C.checkpointed(fit_sample(docs, labels, id_col, text_col, label_id, rows).mapInArrow(read, "id long, s array<double>, w array<binary>, q int, t int"))
    n, good, toxic = sample.agg(F.count("*"), F.sum((F.col("q") != 0).cast("int")), F.sum((F.col("t") != 0).cast("int"))).first()
    counted = sample.select(F.explode("w").alias("w"), (F.col("q") != 0).cast("int").alias("q"), (F.col("t") != 0).cast("int").alias("t")).groupBy("w").agg(F.count("*").alias("c"), F.sum("q").alias("q"), F.sum("t").alias("t")).where("c >= 5")
    counted = C.checkpointed(counted)
    chosen = [telling_marks(counted, "q", n, good or 0), telling_marks(counted, "t", n, toxic or 0)]
    numbers = [{w: i for i, w in enumerate(ws)} for ws in chosen]

    def look_up(batches):
        for batch in batches:
            split = [set(x) for x in batch.column("w").to_pylist()]
            found = [pa.array([sorted(of[w] for w in of.keys() & x) for x in split], pa.list_(pa.int32())) for of in numbers]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", "s", "q", "t")), *found], ["id", "s", "q", "t", "g", "x"])

    got = sample.mapInArrow(look_up, "id long, s array<double>, q int, t int, g array<int>, x array<int>").toArrow().combine_chunks().sort_by("id")
    flat = lambda c: got.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    shares = flat("s").reshape(got.num_rows, SHAPES)

    def fitted(label: str, words_: list[bytes], column: str) -> Logistic:
        y = got.column(label).to_numpy() != 0
        sizes = np.array([len(x) for x in got.column(column).to_pylist()], np.int64)
        return Logistic.fit(words_, shares, y, np.repeat(np.arange(len(y)), sizes), flat(column).astype(np.int64))

    none = Logistic.fit([], np.zeros((0, SHAPES)), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Evidence(fitted("q", chosen[0], "g") if n else none, fitted("t", chosen[1], "x") if toxic else none)


def site_sums(evidence: DataFrame) -> tuple[DataFrame, dict[str, float], int]:
    """From (host, path, p): per path its count and sum with those of its host, what all rows have together (count n, sum s,
    and the strengths host, path of the two priors), and the number of paths.

    Counts and sums combine before they shuffle, so a host with a third of all rows is one row a task. The strength of
    either prior is the one that explains the spread of the sites' means (method of moments): alike sites shrink far.
    """
    paths = C.checkpointed(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    hosts = C.checkpointed(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")))
    t = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    n, s = int(t.n or 0), float(t.s or 0.0)
    mean = min(max(s / n, 1e-6), 1 - 1e-6) if n else 0.5

    def strength(sites, n, s):
        r = sites.agg(F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - mean, 2)).alias("v"), F.sum(n).alias("n"), F.count("*").alias("k")).first()
        noise = mean * (1 - mean)
        spread = ((r.v or 0.0) - noise * max(r.k - 1, 0)) / max(r.n or 1, 1)
        return float(min(max(noise / spread - 1, 2.0), 1e5)) if spread > 1e-12 else 1e5

    totals = {"n": n, "s": s, "host": strength(hosts, "hn", "hs"), "path": strength(paths, "n", "s")}
    hosts = hosts.withColumnRenamed("host", "of_host")
    return paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select("host", "path", "n", "s", "hn", "hs"), totals, paths.count()


def without_own(p, n, s, hn, hs, totals: dict[str, float]):
    """(posterior of the row's path, global mean), both without the row's own p: a path's sum is shrunk to its host's
    posterior, that to the global mean. All are columns, or all numbers: n, s of the path, hn, hs of the host."""
    mean = (totals["s"] - p) / (totals["n"] - 1) if totals["n"] > 1 else p * 0 + 0.5
    a, b = totals["host"], totals["path"]
    host = (hs - p + a * mean) / (hn - 1 + a)
    return (s - p + b * host) / (n - 1 + b), mean


def scored_rows(docs: DataFrame, columns: list[str], labels: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str, label_id: str, threshold: float, rows: int) -> DataFrame:
    """(row, p_doc, p_site, score, keep): row holds the columns of docs. Without the text among them, rows are scored once
    and kept; with it they are scored for the sums and again for the result, and no text is written."""
    evidence = docs.sparkSession.sparkContext.broadcast(fit_evidence(docs, labels, id_col, text_col, label_id, rows))
    plain, texts = C.carried(docs, columns, text_col)
    own = "text" not in plain.columns
    text, host, path = (F.col(f"`{c}`").cast("string").alias(k) for c, k in ((text_col, "text"), (host_col, "host"), (path_col, "path")))

    def run(batches):
        C.drop_caches()
        for batch in batches:
            read = batch.column("text") if "text" in batch.schema.names else texts(batch)
            p = pa.array([evidence.value(t) for t in C.values(read)], pa.float64())
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, rest), p], [*rest, "p"])
        C.give_back()

    def scored(plain: DataFrame) -> DataFrame:
        kept = [f for f in plain.schema if f.name != "text"]
        return plain.mapInArrow(run, T.StructType([*kept, T.StructField("p", T.DoubleType())]))

    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    found = scored(docs.select(row, host, path) if own else docs.select(row, text, host, path))
    found = found if text_col in columns else C.checkpointed(found)
    sites, totals, count = site_sums(scored(docs.select(text, host, path)) if text_col in columns else found)
    sites = sites.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "n", "s", "hn", "hs")
    on = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    out = found.join(F.broadcast(sites) if count <= BROADCAST_SITES else sites, on)
    bound = lambda x: F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
    logit = lambda x: F.log(bound(x) / (1 - bound(x)))
    site, mean = without_own(*map(F.col, ("p", "n", "s", "hn", "hs")), totals)
    score = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(site) - logit(mean))))
    # sums of halves may end a hair below a half
    return out.select("row", F.col("p").alias("p_doc"), site.alias("p_site"), score.alias("score"), (score >= threshold - 1e-9).alias("keep"))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_id: str = "doc_id", threshold: float = 0.5, fit_rows: int = FIT_ROWS, keep_text: bool = True) -> DataFrame:
    """docs with p_doc (the text alone), p_site (posterior of its host and path by the other rows there), score and keep.

    score adds to the log odds of the text those of its site over the global prior, neither of which has the text's own
    p_doc in it, so a path of one document counts no evidence twice; keep is score >= threshold. All rows are scored; only
    the sums move. keep_text=False leaves the text column out of the result. Null or empty texts are scored as texts of no
    words; null hosts or paths are sites of their own. Without usable labels each text scores 1/2, and stays. Repeated
    rows score alike and count each. The four new columns replace columns of the same names; other columns may have any
    name. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c not in ("p_doc", "p_site", "score", "keep") and (keep_text or c != text_col)]
    out = scored_rows(docs, columns, labels, id_col, text_col, host_col, path_col, label_id, threshold, fit_rows)
    return out.select(*C.out_of_one(columns), "p_doc", "p_site", "score", "keep")


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_id: str = "doc_id", threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs that score_quality keeps, in their columns, whatever those are called."""
    out = scored_rows(docs, docs.columns, labels, id_col, text_col, host_col, path_col, label_id, threshold, fit_rows)
    return out.where("keep").select(*C.out_of_one(docs.columns))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return score_quality(docs, C.table(spark, sf_dir, "labels"), keep_text=False).select("doc_id", "source", "lang", "p_doc", "p_site", "score", "keep")
