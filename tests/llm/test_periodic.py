"""Periodic runs against a search of every distance, and the defined results of odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from caseledger.llm.periodic import Run, collapse_runs, collapsed, find_runs, periodic_runs, plant

EMPTY = hashlib.sha256(b"").hexdigest()


def brute(w):
    n, out = len(w), {}
    for d in range(1, n // 3 + 1):
        i = 0
        while i + d < n:
            j = i
            while j + d < n and w[j] == w[j + d]:
                j += 1
            if j > i and j + d - i >= max(24, 3 * d):
                out.setdefault((i, j + d - i), d)
            i = j + 1
    return sorted(Run(s, length, q) for (s, length), q in out.items())


def words(kind, r):
    n = r.randint(0, 180)
    if kind == "two letters":
        return [r.randint(0, 1) for _ in range(n)]
    if kind == "one letter":
        return [0] * n
    if kind == "nested":
        return (([1] * r.randint(1, 20) + [2]) * r.randint(3, 20) + [3]) * r.randint(1, 5)
    if kind == "broken":
        w = [r.randint(0, 1) for _ in range(r.randint(1, 30))] * 10
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] ^= 1
        return w
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        for _ in range(r.randint(2, 9)):
            a, b = b, b + a
        return b
    w = []
    while len(w) < n:
        w += [r.randint(0, 3) for _ in range(r.randint(1, 40))] * r.randint(1, 6) + [9] * r.randint(0, 1)
    return w


@pytest.mark.parametrize("kind", ["two letters", "one letter", "nested", "broken", "fibonacci", "stretches"])
def test_runs_equal_every_distance(kind):
    r = random.Random(kind)
    for _ in range(250):
        w = words(kind, r)
        assert find_runs(np.array(w, dtype=np.int64)) == brute(w)


def test_many_runs_inside_one_take_no_quadratic_time():
    runs = find_runs(np.array(([0] * 30 + [1]) * 4000))
    assert len(runs) == 4001 and Run(0, 124_000, 31) in runs
    assert find_runs(np.zeros(300_000, dtype=np.int64)) == [Run(0, 300_000, 1)]


def expected(ident, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for r in runs for i in range(r.start + r.period, r.start + r.length)}
    top = min(runs, key=lambda r: (-r.length / r.period, r.start, r.period), default=None)
    rest = (top.start, top.length, top.period, 1000 * top.length // top.period) if top else (None,) * 4
    lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    return (ident, len(runs), *rest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_documents_equal_brute_force(spark):
    r = random.Random(5)
    rows = [(i, " ".join(map(str, words(r.choice(["nested", "broken", "stretches"]), r)))) for i in range(120)]
    rows += [(-4, "a\u00a0b " * 30), (7, None), (8, ""), (9, " \t\n"), (None, "x y " * 20), (None, None), (3, rows[3][1]), (500, "tick " * 5000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, period string")
    assert sorted(map(tuple, periodic_runs(df, planted=True).collect()), key=repr) == sorted((expected(*x) for x in rows), key=repr)


def test_empty_table_and_defined_results(spark):
    schema = "doc_id long, text string"
    assert periodic_runs(spark.createDataFrame([], schema)).count() == 0
    got = {r["doc_id"]: r for r in periodic_runs(spark.createDataFrame([(1, None), (2, "one two")], schema)).collect()}
    assert got[1]["n_runs"] == 0 and got[1]["start"] is None and got[1]["runs_sha256"] == got[1]["collapsed_sha256"] == EMPTY
    assert got[2]["collapsed_sha256"] == hashlib.sha256(b"one two").hexdigest()


def test_collapse_keeps_one_period(spark):
    df = spark.createDataFrame([(1, "say " + "tick tock " * 20 + "end"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in collapse_runs(df).collect()} == {1: "say tick tock end", 2: None}


def test_planted_words_follow_the_formula():
    ident = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    w = [str(i) for i in range(97)]
    g = zlib.crc32(str(ident).encode()) // 10
    a = g % 97
    p = 1 + (97 - a) // (3 + g % 8)
    assert plant(w, ident) == [w[i] if i < a else w[a + (i - a) % p] for i in range(97)]
    assert collapsed(w, []) == w
