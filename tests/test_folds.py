"""Bands, linked rows, disjoint matches and headers against plain definitions, a group of many values among them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseledger.operators import layout, ordered


def bands(rows, share=0.15, least=3, anchors=2):
    best = {}
    for x in layout.GUTTERS:
        crossed = [any(a < x < b for a, b in spans) for spans, _ in rows]
        i = 0
        while i < len(rows):
            if crossed[i]:
                i += 1
                continue
            j = i
            while j + 1 < len(rows) and sum(crossed[i : j + 2]) <= share * (j + 2 - i):
                j += 1
            while crossed[j]:
                j -= 1
            held = [s for spans, _ in rows[i : j + 1] for s in spans]
            if j - i + 1 >= least and sum(a for _, a in rows[i : j + 1]) >= anchors and any(b <= x for _, b in held) and any(a >= x for a, _ in held):
                for k in range(i, j + 1):
                    if j - i + 1 > best.get(k, (0, 0))[0]:
                        best[k] = (j - i + 1, x)
            i = j + 1
    out = []
    for k in sorted(best):
        if out and out[-1][2] == k - 1 and out[-1][0] == best[k][1]:
            out[-1][2] = k
        else:
            out.append([best[k][1], k, k])
    return [tuple(b) for b in out if b[2] - b[1] + 1 >= least]


def test_bands_of_random_pages(spark):
    r = random.Random(4)
    pages = {}
    for p in range(60):
        wide = r.choice([0.05, 0.2, 0.5])
        pages[p] = [([(a, a + r.choice([20, 60, 200 if r.random() < wide else 30])) for a in (r.uniform(150, 400) for _ in range(r.randint(0, 3)))], r.random() < 0.4) for _ in range(r.randint(0, 40))]
    d = spark.createDataFrame([(p, k, s, a) for p, rows in pages.items() for k, (s, a) in enumerate(rows)], "page int, row long, spans array<struct<x0:double,x1:double>>, anchor boolean")
    got = {}
    for x in layout.covering_bands(d, "page").collect():
        got.setdefault(x.page, []).append((x.gutter, x.first, x.last))
    want = {p: bands(rows) for p, rows in pages.items()}
    assert sum(map(len, want.values())) > 20
    assert {p: sorted(b) for p, b in got.items()} == {p: sorted(b) for p, b in want.items() if b}


def rows_of(values, gap, span):
    out, first, last = [], None, None
    for v in sorted(values):
        if first is None or v - last > gap or v - first > span:
            first = v
        out.append(first)
        last = v
    return out


@pytest.mark.parametrize("gap,span", [(1.5, 2.0), (0.3, 5.0), (2.0, 0.5), (1.0, 1.0)])
def test_linked_rows(spark, gap, span):
    r = random.Random(7)
    groups = {g: [round(r.uniform(0, 40), 1) for _ in range(r.randint(1, 300))] for g in "abcde"} | {None: [1.0, 1.1, 9.0], "flat": [3.0] * 500}
    d = spark.createDataFrame([(g, v, "x") for g, vs in groups.items() for v in vs] + [("a", None, "x")], "g string, v double, first_ string").repartition(5)
    got = {}
    for x in ordered.linkage(d, "g", "v", gap, span).collect():
        got.setdefault(x.g, []).append((x.v, x.first))
    assert {g: sorted(x) for g, x in got.items()} == {g: list(zip(sorted(vs), rows_of(vs, gap, span), strict=True)) for g, vs in groups.items()}
    one = spark.createDataFrame([(groups["a"],), ([],), (None,)], "v array<double>").select(ordered.linkage_rows(F.col("v"), gap, span).alias("r")).collect()
    assert [x["first"] for x in one[0].r] == rows_of(groups["a"], gap, span) and one[1].r == [] and one[2].r is None


def test_a_group_of_a_million_values(spark):
    d = spark.range(1_000_000).select(F.lit("hot").alias("g"), (F.col("id") * 0.001 + F.floor(F.col("id") / 1000)).alias("v")).repartition(8)
    got = ordered.linkage(d, "g", "v", 0.5, 0.25).groupBy("first").count().collect()
    want = {r[0] for r in zip(rows_of((np.arange(1_000_000) * 0.001 + np.arange(1_000_000) // 1000).tolist(), 0.5, 0.25), strict=True)}
    assert sum(r["count"] for r in got) == 1_000_000 and {r["first"] for r in got} == want


def disjoint(spans):
    kept = []
    for s in sorted(spans):
        if not any(y[1] < s[2] and s[1] < y[2] for y in kept):
            kept.append(s)
    return sorted(kept)


def test_disjoint_matches_of_random_spans(spark):
    r = random.Random(9)
    groups = {g: [(r.randint(0, 3), a := r.randint(0, 200), a + r.randint(0, 25), r.choice("xyz")) for _ in range(r.randint(1, 120))] for g in range(40)}
    d = spark.createDataFrame([(g, *s) for g, ss in groups.items() for s in ss], "g int, priority int, start int, end int, what string")
    got = {}
    for x in layout.disjoint_matches(d, "g").collect():
        got.setdefault(x.g, []).append(tuple(x)[1:])
    assert {g: sorted(x) for g, x in got.items()} == {g: disjoint(ss) for g, ss in groups.items()}


def test_many_matches_of_one_group(spark):
    d = spark.range(300_000).select(F.lit(1).alias("g"), (F.col("id") % 3).alias("priority"), (F.col("id") * 2).alias("start"), (F.col("id") * 2 + 3).alias("end"), F.lit("m").alias("what"))
    assert layout.disjoint_matches(d, "g").count() == 100_001  # every third, and the last, which has none after it


def test_headers_of_random_lines(spark):
    r = random.Random(2)
    lines = [[r.choice(["Head:", "Other:", "- one", "- two", "plain", ":", "- ", ""]) for _ in range(r.randint(0, 12))] for _ in range(200)]

    def plain(ls):
        out, head, used = [], None, False
        for s in [*ls, None]:
            if s is not None and s.startswith("- "):
                used = True
                out.append(f"{head} {s[2:]}" if head else s[2:])
                continue
            if head and not used:
                out.append(head)
            head, used = (s, False) if s is not None and s.endswith(":") else (None, False)
            if s is not None and head is None:
                out.append(s)
        return out

    d = spark.createDataFrame(list(enumerate(lines)), "i int, s array<string>")
    got = {x.i: x.o for x in d.select("i", ordered.distribute_headers(F.col("s")).alias("o")).collect()}
    assert got == {i: plain(ls) for i, ls in enumerate(lines)}


@pytest.mark.parametrize("parts", ["1", "7"])
def test_groups_in_parts_equal_windows(spark, parts):
    r = random.Random(6)
    rows = [(r.choice(["hot"] * 6 + ["a", "b", None]), i, r.choice([None, None, r.randint(0, 9)])) for i in range(900)]
    d = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    plain = lambda df: sorted(map(tuple, df.select("g", "i", "v", "x").collect()), key=repr)
    try:
        assert plain(ordered.forward_fill_in_parts(d, ["g"], ["i"], F.col("v"), "x")) == plain(ordered.forward_fill(d, ["g"], ["i"], F.col("v"), "x"))
        assert plain(ordered.restart_runs_in_parts(d, ["g"], ["i"], "v", "x")) == plain(ordered.restart_runs(d, ["g"], ["i"], "v", "x"))
        got = [(x["place"], x["v"], x["g"], x["i"]) for x in ordered.numbered_sort(d, "v").collect()]
        key = lambda t: [(y is not None, y) for y in t[1:]]
        assert [t[0] for t in sorted(got, key=key)] == list(range(900))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_digests_modulo_any_number_equal_python(spark):
    from hashlib import sha256

    from caseledger.functions.hashing import draw

    ns = [1, 2, 3, 7, 8, 10, 255, 256, 288, 512, 1000, 1024, 4096, 1_000_000, 1 << 20, (1 << 30) - 1, 1 << 30, (1 << 30) + 1, (1 << 31) - 1]
    d = spark.range(40).select("id", *[draw(n, F.col("id")).alias(f"n{n}") for n in ns], draw(F.col("id") + 1, F.col("id")).alias("by"))
    for r in d.collect():
        whole = int(sha256(str(r["id"]).encode()).hexdigest(), 16)
        assert [r[f"n{n}"] for n in ns] == [whole % n for n in ns] and r["by"] == whole % (r["id"] + 1)


def test_power_of_two_draws_read_the_last_digits_only(spark):
    from caseledger.functions.hashing import draw

    assert str(draw(1024, F.col("id"))._jc).count("conv") == 1 and str(draw(1_000_000, F.col("id"))._jc).count("conv") < 8


def test_matches_leave_a_task_in_parts(spark, monkeypatch):
    from caseledger.operators import layout as L

    d = spark.range(300).selectExpr("id % 3 AS g", "1 AS priority", "id * 2 AS start", "id * 2 + 3 AS end", "'x' AS what")
    whole = sorted(map(tuple, L.disjoint_matches(d, "g").collect()))
    monkeypatch.setattr(L, "KEPT_AT_ONCE", 7)
    assert sorted(map(tuple, L.disjoint_matches(d, "g").collect())) == whole and len(whole) == 300


def test_votes_are_dealt_by_key_once(spark):
    from caseledger.operators.aggregates import consolidate

    d = spark.createDataFrame([(k, i, "a") for k in range(5) for i in (1, 2, 3)], "k int, i int, label string")
    plan = consolidate(d, "k", "i", "label", 3, "abstain")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
