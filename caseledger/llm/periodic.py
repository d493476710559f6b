"""Periodic runs of words: stretches that repeat with a period, three times or more and 24 words or more.

Block matching with an Aho-Corasick automaton over integer sequences. Words become integers. At scale B, a power of two
from 8, the keys are the document's aligned blocks of B words (those that start at a multiple of B), and the automaton
finds every occurrence of each. A run of period q holds, in its first length - q words, an aligned block that occurs
again q words on: with q of 1 to 15 for B = 8 and of B to 2B - 1 for every larger B. So an occurrence that far behind an
equal aligned block is a seed; it is extended word by word in both directions as far as words q apart are equal, and a
stretch that is long enough is a run. Of equal stretches the least period counts, which its own scale always seeds.

Before a scale is searched, it is narrowed to the stretches that could hold such a run: inside one, after the first
period, each word has an equal one at most 2B - 1 words before it, for at least max(16, 2B) words on end. Texts without
such a stretch need no automaton; none with a run is missed.

Documents are independent, so Spark deals them over tasks and nothing is shuffled; the memory of a task is that of one
batch and of the longest document's words.

Defined results: a null or wordless text has no words and no run (four nulls, digests of the empty string); a null
identifier draws no planted period; repeated rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right, insort
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_TURNS, FIRST_BLOCK = 24, 3, 8
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


@dataclass(frozen=True, order=True)
class Run:
    start: int
    length: int
    period: int


def _stretch(w: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The largest [lo, hi) around position ``at`` in which words d apart are equal, doubling the part compared."""

    def same(lo: int, hi: int) -> np.ndarray:
        return w[lo:hi] == w[lo + d : hi + d]

    hi, step, last = at, 32, len(w) - d
    while hi < last:
        part = same(hi, min(last, hi + step))
        if not part.all():
            hi += int(part.argmin())
            break
        hi, step = hi + len(part), step * 2
    lo, step = at, 32
    while lo > 0:
        part = same(max(0, lo - step), lo)[::-1]
        if not part.all():
            lo -= int(part.argmin())
            break
        lo, step = lo - len(part), step * 2
    return lo, hi + d


def _likely(back: np.ndarray, block: int, covers: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of words that can hold a run of this scale's periods, each with the period before it; ``covers`` are the
    runs of smaller scales, by start."""
    near = np.concatenate([[False], back < 2 * block, [False]])
    edge = np.flatnonzero(near[1:] != near[:-1])
    first, last = edge[::2], edge[1::2]
    keep = last - first >= max(16, 2 * block)
    out: list[tuple[int, int]] = []
    starts = [c[0] for c in covers]
    reach = list(accumulate((c[1] for c in covers), max))
    for core, hi in zip(first[keep].tolist(), last[keep].tolist(), strict=True):
        # What lies in a run of a smaller period holds no run of a larger one.
        k = bisect_right(starts, core) - 1
        if k >= 0 and hi <= reach[k]:
            continue
        lo = max(0, core - 2 * block)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _seeds(w: np.ndarray, lo: int, hi: int, block: int):
    """(position, distance) of every aligned block of [lo, hi) that occurs again at a distance of this scale."""
    starts = range(-(-lo // block) * block, hi - block + 1, block)
    keys = {s: tuple(w[s : s + block].tolist()) for s in starts}
    searched = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    names: dict[tuple, int] = {}
    for key in keys.values():
        if key not in names:
            names[key] = len(names)
            searched.add_word(key, names[key])
    if not names:
        return
    searched.make_automaton()
    name_at = {s: names[k] for s, k in keys.items()}
    least = 1 if block == FIRST_BLOCK else block
    for end, name in searched.iter(tuple(w[lo:hi].tolist())):
        here = lo + end - block + 1
        s = (here - least) // block * block
        while s >= lo and here - s < 2 * block:
            if name_at.get(s) == name:
                yield s, here - s
            s -= block


def find_runs(words: np.ndarray) -> list[Run]:
    """All runs of a sequence of integers, by start and period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    order = np.argsort(words, kind="stable")
    back = np.full(n, n, dtype=np.int64)
    same = words[order[1:]] == words[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    best: dict[tuple[int, int], int] = {}
    covers: list[tuple[int, int, int]] = []  # runs found at smaller scales, by start
    block = FIRST_BLOCK
    while LEAST_TURNS * (1 if block == FIRST_BLOCK else block) <= n:
        tried: dict[int, int] = {}  # distance -> end of the last stretch extended
        found: list[tuple[int, int, int]] = []
        s, e, q = 0, 0, 1  # the last known run that held a seed
        for lo, hi in _likely(back, block, covers):
            for at, d in _seeds(words, lo, hi, block):
                upto = at + d + block
                # Inside a known run whose period divides d, the stretch is that run.
                if upto <= tried.get(d, -1) or (s <= at and upto <= e and d % q == 0):
                    continue
                k = bisect_right(found, (at, n, n)) - 1
                if k >= 0 and upto <= found[k][1] and d % found[k][2] == 0:
                    s, e, q = found[k]
                    continue
                start, end = _stretch(words, at, d)
                tried[d] = end
                if end - start >= max(LEAST_WORDS, LEAST_TURNS * d):
                    key = (start, end - start)
                    if d < best.get(key, n):
                        best[key] = d
                        insort(found, (start, end, d))
        covers = sorted({*covers, *found})
        block *= 2
    return sorted(Run(s, length, q) for (s, length), q in best.items())


def _numbers(words: list) -> np.ndarray:
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def _widest(runs: list[Run]) -> Run | None:
    top = None
    for r in runs:  # by start and period, so the first of equals stays
        if top is None or r.length * top.period > top.length * r.period:
            top = r
    return top


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those after the first period of any run."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        drop[r.start + r.period] += 1
        drop[r.start + r.length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words


def plant(words: list, ident: int | None) -> list:
    """A tenth of the documents get a period that their identifier draws, as the contract of the query fixes it."""
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return (words[:a] + cycle * (-(-(n - a) // p)))[:n]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """One row per document: its number of runs, the one of greatest exponent, and digests of all runs and of the text
    without repetitions. ``planted`` first writes periods into a tenth of the documents."""

    def run(batches):
        for b in batches:
            rows = []
            for ident, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if planted:
                    words = plant(words, ident)
                runs = find_runs(_numbers(words))
                listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
                digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
                t = _widest(runs)
                rows.append((ident, len(runs), *((t.start, t.length, t.period, 1000 * t.length // t.period) if t else (None,) * 4), *digests))
            columns = zip(*rows, strict=True) if rows else [[]] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    spec = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, spec)


def collapse_runs(docs: DataFrame, text_col: str = "text", out_col: str = "text") -> DataFrame:
    """docs with the text's runs cut to their first period; words are joined by one space, a null text stays null."""

    @F.pandas_udf("string")
    def cut(texts):
        def one(text):
            words = text.encode("utf-8", "surrogatepass").split()
            return b" ".join(collapsed(words, find_runs(_numbers(words)))).decode("utf-8", "surrogatepass")

        return texts.map(one, na_action="ignore")

    return docs.withColumn(out_col, cut(F.col(text_col)))
