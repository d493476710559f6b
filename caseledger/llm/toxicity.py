"""Toxicity: a convolutional text classifier in numpy over hashed word embeddings.

A word's vector is the sum of hashed embeddings of the word, its prefixes and its suffix. Filters of several widths run
over the whole text and each keeps its maximum; a logistic layer joins the maxima. Because a filter of width w is a sum
of w products of single words, every word's products are computed once per worker and a convolution becomes a gather
and an addition. Thresholds are calibrated by language, which is guessed from the text's own function words: a score is
shifted on the logit scale so that its language's threshold lies at 0.5.

Training takes at most ``max_rows`` labelled rows (a documented bound; all rows are scored), chosen by hash, half of
them positive where there are enough; a fifth of these calibrates. A label, language, source or identifier never enters
a score. Rows whose crc32(identifier as text) mod 5 is 0 are never learnt from.

Defined results: null, empty and wordless texts get the score that the filters give to no words at all; without
labelled rows of both kinds every score is the known rate (0 without labels); repeated labels of one identifier count as
toxic if any is; of several texts under one identifier the least is learnt from; null labels are left out; extra columns are ignored; equal texts get equal scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import worker_state

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
FEATURES = 5
MAX_ROWS = 6000
CACHE_WORDS = 150_000
STRIP = ".,;:!?\"'()[]{}*#$%&@|<>«»¿¡-_/\\"
#: Frequent function words, by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are be this by from have or",
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "le la les de et des du une est que dans qui pour pas sur au par avec ce il",
    "es": "el los las de y en un del se con por una para su al lo como más pero sus",
}
LANGUAGES = tuple(FUNCTION_WORDS)


def buckets_of(token: str) -> tuple[int, ...]:
    """Buckets of a lower-cased token: word, prefixes of 3, 4 and 5 bytes, suffix of 4. Bucket 0 stays empty."""
    w, crc, n = (token.strip(STRIP) or token).encode("utf-8", "surrogatepass"), zlib.crc32, BUCKETS - 1
    return crc(w, 1) % n + 1, crc(w[:3], 2) % n + 1, crc(w[:4], 3) % n + 1, crc(w[:5], 4) % n + 1, crc(w[-4:], 5) % n + 1


_VOTES: dict[str, np.ndarray] = {}
for _i, _l in enumerate(LANGUAGES):
    for _w in FUNCTION_WORDS[_l].split():
        _VOTES.setdefault(_w, np.zeros(len(LANGUAGES), dtype=np.float32))[_i] = 1.0


@dataclass
class Cnn:
    embed: np.ndarray  # BUCKETS x DIM
    filters: np.ndarray  # DIM x (sum of WIDTHS) x FILTERS, flattened to DIM x columns
    bias: np.ndarray  # len(WIDTHS) * FILTERS
    out: np.ndarray  # len(WIDTHS) * FILTERS
    out_bias: float
    shift: np.ndarray  # logit of each language's threshold, then the overall one

    def products(self) -> np.ndarray:
        return (self.embed @ self.filters).astype(np.float32)


def convolve(m: np.ndarray) -> list[np.ndarray]:
    """Filter responses by width, positions x FILTERS, from per-word products; texts shorter than a width have none."""
    out, at = [], 0
    for w in WIDTHS:
        parts = [m[j : len(m) - w + 1 + j, at + j * FILTERS : at + (j + 1) * FILTERS] for j in range(w)] if len(m) >= w else [m[:0, at : at + FILTERS]]
        c = parts[0]
        for p in parts[1:]:
            c = c + p
        out.append(c)
        at += w * FILTERS
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Scorer:
    """One per worker: products of known words in a bounded cache."""

    def __init__(self, model: Cnn):
        self.model, self.table = model, model.products()
        self._reset()

    def _reset(self):
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, self.table.shape[1]), dtype=np.float32)
        self.lang = np.zeros((1 << 12, len(LANGUAGES)), dtype=np.float32)

    def _learn(self, new: list[str]) -> None:
        start, need = len(self.index), len(self.index) + len(new)
        while need > len(self.rows):
            self.rows, self.lang = (np.concatenate([x, np.zeros_like(x)]) for x in (self.rows, self.lang))
        ids = np.array([buckets_of(t) for t in new], dtype=np.int64)
        self.rows[start:need] = self.table[ids].sum(axis=1)
        for i, t in enumerate(new):
            self.index[t] = start + i
            if (v := _VOTES.get(t.strip(STRIP))) is not None:
                self.lang[start + i] = v

    def logits(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """(raw logit, language index or -1) of each text."""
        m, z, langs = self.model, [], []
        for text in texts:
            tokens = text.lower().split()
            if len(self.index) > CACHE_WORDS:
                self._reset()
            if new := set(tokens).difference(self.index):
                self._learn(list(new))
            at = np.fromiter(map(self.index.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            pooled = np.concatenate([c.max(axis=0) if len(c) else np.full(FILTERS, -np.inf, dtype=np.float32) for c in convolve(self.rows[at])])
            z.append(float(np.maximum(pooled + m.bias, 0) @ m.out + m.out_bias))
            votes = self.lang[at].sum(axis=0)
            langs.append(int(votes.argmax()) if votes.any() else -1)
        return np.array(z), np.array(langs, dtype=np.int64)

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        z, lang = self.logits(texts)
        return _sigmoid(z - self.model.shift[lang])


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> Cnn:
    """Adam on the log loss; gradients flow through the pooled positions alone."""
    rng = np.random.default_rng(seed)
    n_cols, n_out = sum(WIDTHS) * FILTERS, len(WIDTHS) * FILTERS
    if not len(labels) or labels.min() == labels.max():
        rate_known = float(labels.mean()) if len(labels) else 0.0
        z = 40.0 if rate_known == 1 else -40.0
        return Cnn(np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM, n_cols), np.float32), np.zeros(n_out, np.float32), np.zeros(n_out, np.float32), z, np.zeros(len(LANGUAGES) + 1))
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(t, len(vocab)) for t in x.lower().split()], dtype=np.int64) for x in texts]
    table = np.array([buckets_of(t) for t in vocab], dtype=np.int64).reshape(-1, FEATURES)
    p = {
        "e": rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), "f": rng.normal(0, 0.3, (DIM, n_cols)).astype(np.float32), "b": np.zeros(n_out, np.float32),
        "o": rng.normal(0, 0.3, n_out).astype(np.float32), "c": np.full(1, -1.0, np.float32),
    }
    p["e"][0] = 0
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    fit = np.array([i % 5 != 4 for i in range(len(docs))])
    step = 0
    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(fit))
        for k in range(0, len(order), batch):
            part = order[k : k + batch]
            g = {x: np.zeros_like(v) for x, v in p.items()}
            prod = p["e"] @ p["f"]
            # Whole-word buckets are dropped at random, so that parts of words carry unseen forms.
            use_word = rng.random(len(part)) < 0.5
            for i, whole in zip(part, use_word, strict=True):
                ids = table[docs[i]]
                if not whole:
                    ids = ids[:, 1:]
                if not len(ids):
                    continue
                conv = convolve(prod[ids].sum(axis=1))
                best = [c.argmax(axis=0) if len(c) else None for c in conv]
                pooled = np.concatenate([c[a, np.arange(FILTERS)] if a is not None else np.full(FILTERS, -np.inf, np.float32) for c, a in zip(conv, best, strict=True)])
                act = np.maximum(pooled + p["b"], 0)
                err = float(_sigmoid(act @ p["o"] + p["c"][0]) - labels[i]) / len(part)
                g["o"] += err * act
                g["c"] += err
                d = err * p["o"] * (act > 0)
                g["b"] += d
                at = 0
                for wi, (w, a) in enumerate(zip(WIDTHS, best, strict=True)):
                    dw = d[wi * FILTERS : (wi + 1) * FILTERS]
                    if a is not None and dw.any():
                        for j in range(w):
                            cols = slice(at + j * FILTERS, at + (j + 1) * FILTERS)
                            rows = ids[a + j]  # FILTERS x features
                            g["f"][:, cols] += (p["e"][rows].sum(axis=1) * dw[:, None]).T
                            np.add.at(g["e"], rows.ravel(), np.repeat((p["f"][:, cols] * dw).T, rows.shape[1], axis=0))
                    at += w * FILTERS
            step += 1
            for x in p:
                first[x] = 0.9 * first[x] + 0.1 * g[x]
                second[x] = 0.999 * second[x] + 0.001 * g[x] ** 2
                p[x] -= rate * (first[x] / (1 - 0.9**step)) / (np.sqrt(second[x] / (1 - 0.999**step)) + 1e-8)
            p["e"][0] = 0
    model = Cnn(p["e"], p["f"], p["b"], p["o"], float(p["c"][0]), np.zeros(len(LANGUAGES) + 1))
    z, lang = Scorer(model).logits([t for t, f in zip(texts, fit, strict=True) if not f])
    model.shift = calibrate(z, lang, labels[~fit])
    return model


def calibrate(z: np.ndarray, lang: np.ndarray, y: np.ndarray, least: int = 20) -> np.ndarray:
    """Logit thresholds of best balanced accuracy, the middle of the best range, overall and for each language."""

    def best(z: np.ndarray, y: np.ndarray, default: float) -> float:
        if (y == 1).sum() < least or (y == 0).sum() < least:
            return default
        s = np.sort(np.unique(z))
        cuts = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
        up, down = np.sort(z[y == 1]), np.sort(z[y == 0])
        value = (1 - np.searchsorted(up, cuts) / len(up)) + np.searchsorted(down, cuts) / len(down)
        top = cuts[value >= value.max() - 1e-12]
        return float((top.min() + top.max()) / 2) if len(top) else default

    overall = best(z, y, 0.0)
    return np.array([best(z[lang == k], y[lang == k], overall) for k in range(len(LANGUAGES))] + [overall])


def held_out(ident: Column) -> Column:
    return F.crc32(ident.cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text", balance: bool = True) -> list[tuple[str, int]]:
    """At most ``max_rows`` (text, label) pairs of rows that are not held out, by hash, in a fixed order."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(target).cast("int").alias("_y")).filter("_y is not null and _id is not null").filter(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    if balance:
        classes = [r["_y"] for r in known.select("_y").distinct().orderBy("_y").limit(16).collect()]
        parts = [known.filter(F.col("_y") == c).orderBy(*order).limit(max_rows // max(1, len(classes))) for c in classes]
        chosen = parts[0] if parts else known.limit(0)
        for p in parts[1:]:
            chosen = chosen.unionAll(p)
    else:
        chosen = known.orderBy(*order).limit(max_rows)
    # At most max_rows rows of 12 bytes are broadcast.
    got = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t")).collect()
    got.sort(key=lambda r: (zlib.crc32(str(r["_id"]).encode()), r["_id"]))
    return [(r["_t"] or "", r["_y"]) for r in got]


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    sample = labelled_sample(docs, labels, label_col, max_rows, id_col, text_col)
    model = train([t for t, _ in sample], np.array([y for _, y in sample], dtype=np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 2 MB whatever the corpus

    def run(batches):
        scorer = worker_state(shared, lambda: Scorer(shared.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scorer.scores([t or "" for t in b.column(2).to_pylist()]), pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
