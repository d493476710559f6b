"""Language of texts and of the spans in them.

Script ranges narrow the candidates of a word: a language stays where the word's script has at least a thousandth of that
language's letters; a word in a script that no language uses leaves all of them. A word's score in a language is the
damped sum of the log frequencies of its character n-grams there, mixed with a uniform part, so that unseen n-grams count
alike in all languages. Viterbi labels the words of a text with a penalty for each change of language; the text's language
is that of most letters. Where no stretch of words could gain the penalty by leaving the text's best single language, that
language is Viterbi's path, and no steps are taken; the other texts of a batch take their steps together.

The n-gram and script counts cover every labelled text that is not held out: each task counts its own, and Spark sums what
is at most ``BUCKETS`` and the scripts for each language. That sum, a few MB whatever the corpus, is the model that all
workers get. Language, source and identifier never enter a prediction. Rows whose crc32(identifier as text) mod 3 is 1
are never learnt from.

Defined results: null texts and those without a letter are ``und`` with score 0, and so is everything where no language
is known; of languages with equally many letters the first by name; a null identifier is not held out and not learnt from;
equal texts get equal results; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import worker_state

BUCKETS, GRAMS = 1 << 16, (2, 3, 4)
DAMP, UNIFORM, SWITCH, LEAST_SHARE, OUTSIDE = 0.4, 0.02, 6.0, 1e-3, 12.0
CACHE_WORDS, CACHE_VALUES, LONG_WORD = 300_000, 20_000_000, 40
UND = "und"
#: Letters of one script, by the first word of their Unicode name; what has no row here is of script "OTHER".
SCRIPTS = "OTHER LATIN GREEK CYRILLIC ARMENIAN HEBREW ARABIC DEVANAGARI BENGALI GURMUKHI GUJARATI TAMIL TELUGU KANNADA MALAYALAM SINHALA THAI LAO TIBETAN MYANMAR GEORGIAN HANGUL ETHIOPIC KHMER HIRAGANA KATAKANA CJK".split()
_PARTS = regex.compile(r"[\p{L}\p{M}]{1,%d}" % LONG_WORD).findall
_REST = regex.compile(r"[^\p{L}\p{M}]+").sub
_LETTER = regex.compile(r"\p{L}").search


def script_ranges() -> tuple[np.ndarray, np.ndarray]:
    """First code point and script of every range of letters of one script, gaps belonging to the range before."""
    number = {s: i for i, s in enumerate(SCRIPTS)}
    first, script, last = [0], [0], 0
    for c in range(0x41, min(sys.maxunicode, 0x30000)):
        if unicodedata.category(chr(c))[0] == "L":
            s = number.get(unicodedata.name(chr(c), "OTHER").replace("FULLWIDTH ", "").replace("MICRO", "GREEK").split(" ")[0].split("-")[0], 0)
            if s != last:
                first.append(c)
                script.append(s)
                last = s
    return np.array(first, dtype=np.uint32), np.array(script, dtype=np.int64)


_FIRST, _SCRIPT = script_ranges()


def held_out(ident: Column) -> Column:
    return F.crc32(ident.cast("string").cast("binary")) % 3 == 1


def words_of(text: str) -> list[str]:
    """Runs of non-spaces; long ones, as of scripts without spaces, are cut into parts."""
    out = text.split()
    if max(map(len, out), default=0) > LONG_WORD:
        out = [p for w in out for p in (_PARTS(w) if len(w) > LONG_WORD else (w,))]
    return out


def plain(word: str) -> str:
    """The lower-cased letters of a word between marks of its ends and of what is not a letter."""
    w = word.lower()
    return f"_{w}_" if w.isalpha() else "_" + _REST("_", w).strip("_") + "_"


@dataclass
class Features:
    """N-grams and letters of many words, laid out one after another."""

    bucket: np.ndarray
    of: np.ndarray  # word of each bucket
    letters: np.ndarray
    script: np.ndarray  # that of the word's first letter


def features(words: list[str]) -> Features:
    forms = [plain(w) for w in words]
    c = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter(map(len, forms), dtype=np.int64, count=len(forms))
    of = np.repeat(np.arange(len(forms)), size)
    letter = c != 0x5F
    buckets, owners = [], []
    mixed = np.zeros(len(c), dtype=np.uint64)
    for k in range(max(GRAMS)):
        mixed = mixed[: max(0, len(c) - k)] * np.uint64(0x9E3779B97F4A7C15) + c[k:].astype(np.uint64) + np.uint64(1)
        if k + 1 in GRAMS:
            within = of[: len(mixed)] == of[k:]
            h = mixed[within]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            buckets.append((h >> np.uint64(48)).astype(np.int64) % BUCKETS)
            owners.append(of[: len(mixed)][within])
    letters = np.bincount(of, weights=letter, minlength=len(forms)).astype(np.int64)
    at = np.minimum(np.cumsum(size) - size + 1, max(0, len(c) - 1))
    script = _SCRIPT[np.searchsorted(_FIRST, c[at], "right") - 1] if len(c) else np.zeros(0, dtype=np.int64)
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    has = letters[owner] > 0
    return Features(bucket[has], owner[has], letters, script)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS + 1) x languages, log frequencies
    scripts: np.ndarray  # scripts x languages, whether a language is a candidate

    @staticmethod
    def of_counts(langs: list[str], lang: np.ndarray, slot: np.ndarray, n: np.ndarray) -> Model:
        counts = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
        np.add.at(counts, (slot, lang), n)
        grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
        share = grams / np.maximum(grams.sum(axis=0), 1)
        table = np.log((1 - UNIFORM) * share + UNIFORM / BUCKETS) * DAMP
        candidate = scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=0), 1)
        candidate[~candidate.any(axis=1)] = True
        return Model(langs, table.astype(np.float32), candidate)


class Labeller:
    """One per worker: scores of known words in a bounded cache, and Viterbi."""

    def __init__(self, model: Model):
        self.model, self.k = model, len(model.langs)
        self.most = min(CACHE_WORDS, CACHE_VALUES // max(1, self.k))
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, self.k), dtype=np.float32)
        self.letters = np.zeros(1 << 12, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        start, need = len(self.index), len(self.index) + len(new)
        while need > len(self.letters):
            self.rows, self.letters = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.letters, np.zeros_like(self.letters)])
        f = features(new)
        got = self.model.table[f.bucket]
        s = np.stack([np.bincount(f.of, weights=got[:, j], minlength=len(new)) for j in range(self.k)], axis=1)
        open_ = self.model.scripts[f.script]
        floor = np.where(open_, s, np.inf).min(axis=1) - OUTSIDE
        s = np.where(open_, s, floor[:, None])
        s[f.letters == 0] = 0
        self.rows[start:need] = s - s.max(axis=1, keepdims=True)
        self.letters[start:need] = f.letters
        self.index.update(zip(new, range(start, need), strict=True))

    def label(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(label of each word, letters of each word, scores) of every text."""
        if len(self.index) > self.most:
            self._reset()
        cut = [words_of(t) for t in texts]
        if new := list({w for ws in cut for w in ws}.difference(self.index)):
            self._learn(new)
        at = [np.fromiter(map(self.index.__getitem__, ws), dtype=np.int64, count=len(ws)) for ws in cut]
        scores = [self.rows[a] for a in at]
        paths: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(texts)
        mixed = []
        for i, s in enumerate(scores):
            if not len(s):
                continue
            top = int(s.sum(axis=0, dtype=np.float64).argmax())
            if self.k > 1 and self._may_gain(s, top):
                mixed.append(i)
            else:
                paths[i] = np.full(len(s), top, dtype=np.int8)
        for i, p in zip(mixed, viterbi([scores[i] for i in mixed], SWITCH), strict=True):
            paths[i] = p
        return [(p, self.letters[a], s) for p, a, s in zip(paths, at, scores, strict=True)]

    @staticmethod
    def _may_gain(s: np.ndarray, top: int) -> bool:
        """Whether a stretch of words scores better by a whole penalty in other languages than in the best one."""
        if float(s[:, top].min()) > -1e-9:
            return False
        others = s.copy()
        others[:, top] = -np.inf
        run = np.cumsum(others.max(axis=1).astype(np.float64) - s[:, top])
        low = np.minimum.accumulate(np.concatenate([[0.0], run[:-1]]))
        return bool((run - low).max() >= SWITCH)

    def verdicts(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """(language, score): the score is the share of letters in the language's spans, times how surely these are its own."""
        langs, marks = [], []
        if not self.k:
            return [UND] * len(texts), [0.0] * len(texts)
        for text, (path, letters, s) in zip(texts, self.label(texts), strict=True):
            if not _LETTER(text):
                langs.append(UND)
                marks.append(0.0)
                continue
            weight = np.bincount(path, weights=letters, minlength=self.k)
            best = int(weight.argmax())
            total = s[path == best].sum(axis=0, dtype=np.float64)
            sure = 1 / np.exp(np.clip(total - total[best], -50, 50)).sum()
            langs.append(self.model.langs[best])
            marks.append(float(weight[best] / max(weight.sum(), 1) * sure))
        return langs, marks


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """The best labels of every sequence of word scores, a change costing ``penalty``; all sequences step together.

    Of equal paths the one that stays, and of equal labels the first, is taken."""
    if not scores:
        return []
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    size = np.array([len(scores[i]) for i in order])
    flat = np.concatenate([scores[i] for i in order]).astype(np.float64)
    start = np.cumsum(size) - size
    k = flat.shape[1]
    own = np.arange(k, dtype=np.int8)[None, :]
    back = np.zeros(flat.shape, dtype=np.int8)
    value = np.zeros((len(size), k))
    active = np.searchsorted(-size, -np.arange(size[0]), "left")  # sequences longer than t
    for t, m in enumerate(active.tolist()):
        at = start[:m] + t
        v = value[:m]
        if t:
            best = v.argmax(axis=1)
            moved = v[np.arange(m), best][:, None] - penalty
            stays = v >= moved
            back[at] = np.where(stays, own, best[:, None].astype(np.int8))
            v = np.where(stays, v, moved)
        value[:m] = v + flat[at]
    path = np.zeros(len(flat), dtype=np.int8)
    state = value.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        m = active[t]
        at = start[:m] + t
        path[at] = state[:m]
        state[:m] = back[at, state[:m]]
    out: list[np.ndarray] = [path[:0]] * len(scores)
    for j, i in enumerate(order):
        out[i] = path[start[j] : start[j] + size[j]]
    return out


def count_features(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, slot, n) over all rows: how often each n-gram bucket and each script's letters occur in a language."""
    kinds = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for b in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, seen in words.items():
                f, times = features(list(seen)), np.fromiter(seen.values(), dtype=np.float64, count=len(seen))
                total = held.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS)))
                total[:BUCKETS] += np.bincount(f.bucket, weights=times[f.of], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(f.script, weights=times * f.letters, minlength=len(SCRIPTS))
        for lang, total in held.items():
            slot = np.flatnonzero(total).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(total[slot].astype(np.int64))], schema=kinds)

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    return known.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The model of all labelled rows given; what reaches the driver is bounded by languages x (BUCKETS + scripts)."""
    counts = count_features(docs, lang_col, text_col).toArrow()
    names = counts.column("lang").to_pylist()
    langs = sorted(set(names))
    number = {x: i for i, x in enumerate(langs)}
    lang = np.fromiter((number[x] for x in names), dtype=np.int64, count=len(names))
    return Model.of_counts(langs, lang, counts.column("slot").to_numpy().astype(np.int64), counts.column("n").to_numpy())


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text."""
    held = held_out(F.col(id_col))
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs.filter(~held), lang_col, text_col))

    def run(batches):
        labeller = worker_state(shared, lambda: Labeller(shared.value))
        for b in batches:
            langs, marks = labeller.verdicts([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(marks, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """docs with the spans of each text, as of :func:`words_of`: (first word, number of words, language). Words without letters
    go with the others; a text without a letter has no span."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,words:int,lang:string>>")
    def spans(texts):
        labeller = worker_state(shared, lambda: Labeller(shared.value))
        out = []
        if not labeller.k:
            return texts.__class__([[]] * len(texts))
        for path, letters, _ in labeller.label([t or "" for t in texts]):
            edge = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1], [True]])) if letters.any() else np.zeros(1, dtype=np.int64)
            out.append([(int(a), int(z - a), shared.value.langs[path[a]]) for a, z in zip(edge[:-1], edge[1:], strict=True)])
        return texts.__class__(out)

    return docs.withColumn(out_col, spans(F.col(text_col)))
