"""Quality: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its score, so that
P(grade <= k) = sigmoid(threshold_k - score). A row gets its expected grade and the probability of at least the grade
asked for, which selects it. Features are means over all tokens of the whole text: the token without punctuation, its
shape (letter case, digits, marks), its trailing marks and its length class; and squashed document statistics.

Fitting takes at most ``max_rows`` labelled rows (a documented bound), by hash and balanced by grade; identifiers that
crc32 mod 5 holds out are not learnt from. Everything else covers all rows.

Defined results: null, empty and wordless texts have no features but the constant of emptiness and are graded by the
thresholds alone with the lowest expected grade; with fewer than two grades known every row gets that grade (or no
number and probability 1 without labels); repeated labels count once with the highest grade; of several texts under one
identifier the least is learnt from; extra columns are kept by
``select_quality`` and ignored by ``quality_scores``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import worker_state
from caseledger.llm.toxicity import held_out, labelled_sample

BUCKETS = 1 << 14
STATS = 5
MAX_ROWS = 4000
CACHE_TOKENS = 150_000
_MARKS = re.compile(r"[^\w\s]+$")
EMPTY_SCORE = -30.0
#: A longer token (a script without spaces) is read as pieces of so many characters, each a token.
LONG, PIECE = 40, 4


def tokens_of(text: str) -> list[str]:
    tokens = text.split()
    if max(map(len, tokens), default=0) <= LONG:
        return tokens
    return [p for t in tokens for p in ([t] if len(t) <= LONG else [t[i : i + PIECE] for i in range(0, len(t), PIECE)])]


def shape(token: str, word: str, marks: str) -> str:
    """Letter case of the word and its marks, or runs of kinds where the word is not letters alone."""
    if word.isalpha():
        return ("a" if word.islower() else "Aa" if word.istitle() else "A" if word.isupper() else "aA") + marks
    out = []
    for c in token:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def features(token: str) -> tuple[int, ...]:
    if token.isalpha():
        word, end = token, ""
    else:
        found = _MARKS.search(token)
        end = found[0][:4] if found else ""
        word = token[: found.start()] if found else token
    crc, low = zlib.crc32, word.lower().encode("utf-8", "surrogatepass")
    return crc(low, 1) % BUCKETS, crc(shape(token, word, end).encode("utf-8", "surrogatepass"), 2) % BUCKETS, crc(end.encode("utf-8", "surrogatepass"), 3) % BUCKETS, crc(b"%d" % (min(len(token), 24) // 3), 4) % BUCKETS


def statistics(text: str, n: int, distinct: int) -> list[float]:
    """Squashed facts of the whole text: size, variety of words and lines, mean length of a word, and a constant."""
    lines = [x for x in text.split("\n") if x]
    return [min(1.0, np.log1p(n) / 10), distinct / n, 1 - len(set(lines)) / max(1, len(lines)), min(1.0, len(text) / n / 20), 1.0]


@dataclass
class Ordinal:
    grades: list[int]
    weights: np.ndarray  # BUCKETS
    stats: np.ndarray  # STATS
    cuts: np.ndarray  # len(grades) - 1, ascending

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Rows x grades."""
        below = 1 / (1 + np.exp(-np.clip(self.cuts[None, :] - score[:, None], -60, 60)))
        edge = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edge, axis=1)


class Scorer:
    def __init__(self, model: Ordinal):
        self.model, self.known = model, {}

    def score(self, text: str) -> float:
        tokens = tokens_of(text)
        if not tokens:
            return EMPTY_SCORE
        if len(self.known) > CACHE_TOKENS:
            self.known = {}
        known, w = self.known, self.model.weights
        distinct = set(tokens)
        for t in distinct.difference(known):
            known[t] = float(sum(w[i] for i in features(t)))
        return sum(map(known.__getitem__, tokens)) / len(tokens) + float(np.dot(self.model.stats, statistics(text, len(tokens), len(distinct))))

    def rows(self, texts: Iterable[str], keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = np.array([self.score(t) for t in texts], dtype=np.float64)
        if not self.model.grades:
            return s, np.full(len(s), np.nan), np.ones(len(s))
        p = self.model.probabilities(s)
        grades = np.array(self.model.grades)
        return s, p @ grades, p[:, grades >= keep].sum(axis=1)


def fit(texts: list[str], grades: list[int], steps: int = 300, rate: float = 0.1, l2: float = 1e-4) -> Ordinal:
    """Adam on the negative log likelihood over mean token features; thresholds stay ordered by exponential gaps."""
    levels = sorted(set(grades))
    if len(levels) < 2:
        return Ordinal(levels, np.zeros(BUCKETS), np.zeros(STATS), np.zeros(0))
    known: dict[str, tuple[int, ...]] = {}
    rows, cols, vals, stats, y = [], [], [], [], []
    for text, grade in zip(texts, grades, strict=True):
        tokens = tokens_of(text)
        if not tokens:
            continue
        at: list[int] = []
        for t in tokens:
            if t not in known:
                known[t] = features(t)
            at += known[t]
        u, c = np.unique(np.array(at), return_counts=True)
        rows.append(np.full(len(u), len(y)))
        cols.append(u)
        vals.append(c / len(tokens))
        stats.append(statistics(text, len(tokens), len(set(tokens))))
        y.append(levels.index(grade))
    if not rows:
        return Ordinal(levels[:1], np.zeros(BUCKETS), np.zeros(STATS), np.zeros(0))
    r, c, v = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    x, y_ = np.array(stats), np.array(y)
    k = len(levels)
    scale = len(y_) / (k * np.maximum(1, np.bincount(y_, minlength=k)))[y_]  # grades weigh the same
    p = {"w": np.zeros(BUCKETS), "s": np.zeros(STATS), "a": np.zeros(1), "g": np.zeros(max(0, k - 2))}
    first, second = ({n: np.zeros_like(q) for n, q in p.items()} for _ in range(2))
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -60, 60)))
    for step in range(1, steps + 1):
        score = np.bincount(r, v * p["w"][c], minlength=len(y_)) + x @ p["s"]
        cuts = p["a"][0] + np.concatenate([[0.0], np.cumsum(np.exp(p["g"]))])
        hi = np.where(y_ < k - 1, sig(cuts[np.minimum(y_, k - 2)] - score), 1.0)
        lo = np.where(y_ > 0, sig(cuts[np.maximum(y_ - 1, 0)] - score), 0.0)
        prob = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / prob * scale / len(y_), lo * (1 - lo) / prob * scale / len(y_)
        ds = dhi - dlo  # of the negative log likelihood, by score
        dc = np.bincount(np.minimum(y_, k - 2), -dhi * (y_ < k - 1), minlength=k - 1) + np.bincount(np.maximum(y_ - 1, 0), dlo * (y_ > 0), minlength=k - 1)
        g = {"w": np.bincount(c, v * ds[r], minlength=BUCKETS) + l2 * p["w"], "s": x.T @ ds + l2 * p["s"], "a": np.array([dc.sum()]), "g": np.array([dc[j + 1 :].sum() for j in range(k - 2)]) * np.exp(p["g"])}
        for n in p:
            first[n] = 0.9 * first[n] + 0.1 * g[n]
            second[n] = 0.999 * second[n] + 0.001 * g[n] ** 2
            p[n] = p[n] - rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return Ordinal(levels, p["w"], p["s"], p["a"][0] + np.concatenate([[0.0], np.cumsum(np.exp(p["g"]))]))


SCHEMA = "score double, expected_grade double, tail_probability double"


def _train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> Ordinal:
    sample = labelled_sample(docs, labels, label_col, max_rows, id_col, text_col)
    return fit([t for t, _ in sample], [y for _, y in sample])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep_grade: int = 1, least: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text_hash, held_out, score, expected_grade, tail_probability, keep) of every whole text."""
    model = _train(docs, labels, id_col, text_col, label_col, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 128 KB whatever the corpus

    def run(batches):
        scorer = worker_state(shared, lambda: Scorer(shared.value))
        for b in batches:
            s, e, t = scorer.rows((x or "" for x in b.column(3).to_pylist()), keep_grade)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(s), pa.array(e), pa.array(t)], names=["doc_id", "text_hash", "held_out", "score", "expected_grade", "tail_probability"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id long, text_hash long, held_out boolean, {SCHEMA}")
    return scored.withColumn("keep", F.col("tail_probability") >= least)


def select_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep_grade: int = 1, least: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of docs, all columns unchanged, whose tail probability is at least ``least``; nothing is shuffled."""
    model = _train(docs, labels, id_col, text_col, label_col, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col)

    def run(batches):
        scorer = worker_state(shared, lambda: Scorer(shared.value))
        for b in batches:
            *_, tail = scorer.rows((x or "" for x in b.column(text_at).to_pylist()), keep_grade)
            yield b.filter(pa.array(tail >= least))

    return docs.mapInArrow(run, docs.schema)
