"""Token counts of a unigram vocabulary by a count-only Viterbi search (operator 6)."""

from __future__ import annotations

import math
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm import common as C

SPACE = "▁"
#: What a character that no piece covers costs below the worst piece.
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int, bool]:
    """Pieces with log probabilities, the number of the unknown piece, and whether bytes stand in for unknown characters, of
    a sentencepiece model file.

    A unigram model's scores are log probabilities already. A merge model's are minus the rank of a merge (and a placeholder
    for pieces that no merge makes), sums of which mean nothing; there a piece has the probability that Zipf's law gives
    its place in the vocabulary: 1 / place, over the sum of all. Nothing is estimated from texts.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    real = [i for i in range(n) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    scores = {i: float(model.get_score(i)) for i in real}
    if sum(s == int(s) for s in scores.values()) > len(real) // 2:
        whole = math.log(math.fsum(1 / k for k in range(1, len(real) + 1)))
        scores = {i: -math.log(k) - whole for k, i in enumerate(real, 1)}
    return [("<unk>", 0.0)] + [(model.id_to_piece(i), scores[i]) for i in real], 0, any(model.is_byte(i) for i in range(n))


class Counter(dict):
    """Pieces and score of the best split of a segment.

    With split (the pre-split of the tokenizers library) a segment is a word with the one space mark before it, and pieces
    of several space marks never match. Without, the whole vocabulary is searched: a segment is a run of space marks and
    the word after it, cut only where no piece can cross; a vocabulary that has pieces across is searched uncut. So the
    best split of a text is that of its segments, and each distinct segment is searched once per worker, up to a bound. An Aho-Corasick automaton lists the pieces that end at each
    character; the dynamic program carries the best score and the number of pieces, never the path. Ties go as in the
    public tokenizers: a path is replaced by a strictly better one only, and paths are tried by their last piece's start,
    leftmost first. A character that no single-character piece covers may be an unknown piece, scored below the worst
    piece by a fixed penalty; it counts as its UTF-8 bytes where the vocabulary has bytes to fall back on, else
    neighbouring unknown pieces are one token.
    """

    bound = 500_000

    def __init__(self, pieces: list[tuple[str, float]], unknown: int, split: bool = True, byte_fallback: bool = False):
        super().__init__()
        self.bytes = byte_fallback
        real = [p for i, (p, _) in enumerate(pieces) if i != unknown]
        crossed = SPACE not in real or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in real)
        self.split = split
        self.segments = (lambda text: [text]) if crossed else re.compile(f"{SPACE}+[^{SPACE}]*").findall
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if i != unknown and piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for i, (_, s) in enumerate(pieces) if i != unknown), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, segment: str) -> tuple[int, float]:
        n = len(segment)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (size, score) in self.automaton.iter(segment):
            ends[last + 1].append((last + 1 - size, score))
        best = [(0.0, 0, False)] + [None] * n  # score, pieces, does it end in an unknown piece
        for end in range(1, n + 1):
            found, single = None, False
            for start, score in sorted(ends[end]):
                single |= start == end - 1
                total = best[start][0] + score
                if found is None or total > found[0]:
                    found = (total, best[start][1] + 1, False)
            if not single:
                total, count, open_ = best[end - 1]
                if found is None or total + self.unknown > found[0]:
                    more = len(segment[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else not open_
                    found = (total + self.unknown, count + more, True)
            best[end] = found
        out = (best[n][1], best[n][0])
        if len(self) < self.bound and n < 64:
            self[segment] = out
        return out

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        text = text if text.startswith(SPACE) else SPACE + text
        got = [self[SPACE + x] for x in text.split(SPACE)[1:]] if self.split else [self[x] for x in self.segments(text)]
        return sum(n for n, _ in got), sum(s for _, s in got)


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text", split: bool = True) -> DataFrame:
    """docs with n_tokens and token_score (the best split's summed score) of each whole text.

    A text starts with a space mark and its spaces are space marks; nothing else is normalised. split
    cuts it at every space mark first (Counter); op6 does not. Row by row, without a
    shuffle; a task holds one batch and its segment cache. Null or empty texts have no tokens and score 0. Repeated rows
    count alike. Columns named n_tokens, token_score are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_tokens", "token_score")]
    plain, texts = C.carried(docs, columns, text_col)

    def run(batches):
        def load():
            pieces, unknown, bytes_ = vocabulary(model_path)
            return Counter(pieces, unknown, split, bytes_)

        counter = C.worker_cache(("unigram", model_path, split), load)
        for batch in batches:
            got = [counter.count(t) for t in texts(batch).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([n for n, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())], ["row", "n_tokens", "token_score"])

    out = plain.mapInArrow(run, T.StructType([plain.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("token_score", T.DoubleType())]))
    return out.select(*C.out_of_one(columns), "n_tokens", "token_score")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text"))
    return count_tokens(docs, model_path(), split=False).select("doc_id", "source", "n_tokens", "token_score")
