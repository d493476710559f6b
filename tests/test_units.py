"""Expressions and operators on hand-made rows: boundaries, ties, blanks and order independence."""

import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from caseledger.functions import atoms as A
from caseledger.functions import dates as D
from caseledger.functions import hashing as H
from caseledger.functions import prose as P
from caseledger.functions import text as X
from caseledger.functions import forms as R
from caseledger.operators import joins, layout, ordered, provenance, records, scenario, synthesis
from caseledger.plans.projection import compile_projection
from caseledger.sources import files


def one(spark, expr, **cols):
    names = list(cols) or ["_"]
    ddl = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(cols.values()) or ("",)], ddl).select(expr.alias("x")).first()["x"]


def test_hash_mod_is_big_integer_modulo(spark):
    keys = [f"k{i}" for i in range(50)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (1, 7, 100, 1024, 1826, 1_000_000):
        got = [r.x for r in df.select(H.draw(n, F.col("k"), F.lit("s")).alias("x")).collect()]
        assert got == [int(hashlib.sha256(f"{k}|s".encode()).hexdigest(), 16) % n for k in keys]
    with pytest.raises(ValueError):
        H.hex_mod(F.lit(""), 1 << 31)


def test_weighted_pick_orders_differ(spark):
    w = {"z": 1, "a": 3}
    for by_key in (False, True):
        names = sorted(w) if by_key else list(w)
        table = [n for n in names for _ in range(w[n])]
        for k in "pqrs":
            roll = int(hashlib.sha256(k.encode()).hexdigest(), 16) % 4
            assert one(spark, H.weighted_pick(w, F.col("k"), by_key=by_key), k=k) == table[roll]


def test_quantile_table():
    t = H.quantile_table(45, 0.6)
    assert len(t) == 1024 and t == sorted(t) and t[511] <= 45 <= t[512] and min(t) >= 0


@pytest.mark.parametrize(("text", "want"), [("07-AUG-2009", "2009-08-07"), ("7-AUG-2009 x", "2009-08-07"), ("07-aug-2009", ""), ("31-FEB-2010", "2010-02-31"), ("", "")])
def test_iso_text(spark, text, want):
    assert one(spark, D.iso_text(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("TIME: 930 HOURS", "09:30"), ("TIME: 2359", "23:59"), ("TIME: 2400", ""), ("none", "")])
def test_military_time(spark, text, want):
    assert one(spark, D.military_time(F.col("t")), t=text) == want


def test_dates(spark):
    assert one(spark, D.to_date(F.col("t")), t="6/7/2022") == date(2022, 6, 7)
    assert one(spark, D.to_date(F.col("t")), t="2022-6-7") == date(2022, 6, 7)
    assert one(spark, D.to_date(F.col("t")), t="2022-13-7") is None
    for year, want in ((2006, "free_prose"), (2007, "human_error"), (2010, "ad_hoc"), (2018, "ad_hoc"), (2019, "modern_six"), (2101, None)):
        assert one(spark, D.regime(F.lit(year))) == want
    for age, want in ((731, "Completed"), (730, "In Progress"), (183, "Pending")):
        assert one(spark, D.status_by_age(F.date_sub(F.lit(date(2026, 8, 9)), age), F.lit(date(2026, 8, 9)))) == want


@pytest.mark.parametrize(
    ("text", "head", "form"),
    [("Equipment Failure: valve stuck", "Equipment Failure", ":"), ("Supervision – none on site", "Supervision", "–"), ("Communication - poor", "Communication", "-"), ("a lower start: no", None, None), ("One Two Three Four Five Six Seven: no", None, None), ("No separator here", None, None)],
)
def test_parse_head(spark, text, head, form):
    got = one(spark, X.parse_head(F.col("t")), t=text)
    assert (got["head"], got["form"]) == (head, form)


def test_text_functions(spark):
    assert one(spark, X.split_enumerated(F.col("t")), t="1. Fix it\n2) Check\n a) twice") == ["Fix it", "Check", "twice"]
    assert one(spark, X.split_enumerated(F.col("t")), t="None.") == []
    assert one(spark, X.money(F.col("t")), t="lost $ 1,250.50 in all") == 1250.5
    assert one(spark, X.money(F.col("t")), t="nothing") is None
    assert one(spark, X.area_block(F.col("t")), t="at GC-0778 today") == "GC 778"
    assert one(spark, X.normalise_head(F.col("t")), t=" Human_Performance  Error! ") == "human performance error"
    assert one(spark, X.clause_list(F.split("t", ",")), t="a,b,c") == "a, b and c"
    assert one(spark, X.joined_key(F.col("a"), F.col("b"), F.col("c")), a="GC", b="1", c="d") == "GC-1-d"
    assert one(spark, X.joined_key(F.col("a"), F.col("b"), F.col("c")), a="GC", b=" ", c="d") is None
    assert one(spark, X.last_sentence_with(F.col("t"), "should"), t="They should not have done this. Bye. They should have checked the valve first.") == "They should have checked the valve first."


def test_types_of_an_incident(spark):
    spec = ({"Fatality": ("HS", "Injury"), "Injury": ("HS", None), "Pollution": ("Env", "LOPC")}, {"Incident >$25K": ("Cost", None)}, {"Fire": "Fire", "Crane": None, "Blowout": "LOWC"}, ["Muster"], A.PRECEDENCE)
    types = lambda *atoms: tuple(one(spark, A.resolve_types(F.split("t", ";"), *spec), t=";".join(atoms)))
    assert types("Pollution", "Injury") == ("Loss Event", "HS", None, None)  # a null of the better-ranked atom stays
    assert types("Incident >$25K", "Crane", "Blowout", "Fire") == ("Loss Event", "Cost", None, "LOWC")
    assert types("Fire") == ("Loss Event", None, None, "Fire")
    assert types("Muster") == ("Near Hit", None, None, None)
    assert types("Unknown") == (None, None, None, None)
    assert one(spark, A.top_atom(F.split("t", ";"), A.PRECEDENCE), t="Pollution;LTA >3 days") == "LTA >3 days"
    assert one(spark, A.top_atom(F.split("t", ";"), A.PRECEDENCE), t="Other;Incident >$25K") == "Incident >$25K"


def test_urls(spark):
    url = lambda href: tuple(one(spark, P.resolve_url(F.col("h"), "https://site.example/", ("dead.example",), "live.example"), h=href))
    assert url("sites/x y.pdf") == ("https://site.example/sites/x%20y.pdf", "https://site.example/sites/x y.pdf", False)
    assert url(" http://dead.example/a%20b/c&d.pdf?q=1#p ") == ("https://live.example/a%20b/c&d.pdf?q=1#p", "https://live.example/a b/c&d.pdf?q=1#p", True)
    assert url("http://other.example/z") == ("http://other.example/z", "http://other.example/z", False)


def test_prose_dates(spark):
    assert one(spark, P.prose_dates(F.col("t")), t="2020-05-31 then may 2, 2024, 7 JUNE 2021, 1-jan-1999, 05/02/2024 and 13/45/2020") == ["2024-05-02", "2021-06-07", "1999-01-01", "2024-05-02", "2020-05-31"]
    assert one(spark, P.shift_prose_dates(F.col("t"), F.lit(1)), t="MAY 2, 2024; may 2, 2024; 05/02/2024; 9-Oct-2020") == "MAY 3, 2024; May 3, 2024; 5/3/2024; 10-OCT-2020"
    text = "On May 31, 2020 or 5/31/2020, 31-MAY-2020, 2020-05-31; 31 May 2020; never 2/30/2020."
    assert one(spark, P.shift_prose_dates(F.col("t"), F.lit(1)), t=text) == "On June 1, 2020 or 6/1/2020, 01-JUN-2020, 2020-06-01; 1 June 2020; never 2/30/2020."


@pytest.mark.parametrize(("name", "want"), [("GC 0778 07-AUG-2009 X Redacted.pdf", ("GC", "778", "2009-08-07", True, [])), ("plain.pdf", ("", "", "", False, ["no_date", "no_lease"])), ("MC-12_20201399.pdf", ("MC", "12", "", False, ["bad_date"]))])
def test_filenames(spark, name, want):
    assert tuple(one(spark, P.parse_filename(F.col("n")), n=name)) == want


def test_atoms(spark):
    assert one(spark, A.split_atoms(F.col("c")), c=" - Fire - Injury - ") == ["Fire", "Injury"]
    assert one(spark, A.top_atom(A.split_atoms(F.col("c")), A.PRECEDENCE), c="Fire - other injury - Fatality") == "Fatality"
    got = one(spark, A.risk_matrix(A.split_atoms(F.col("c")), F.lit(True)), c="Crane - Injury")
    assert tuple(got) == ("E", 5, 25, "Very Serious Incident")
    assert tuple(one(spark, A.risk_matrix(A.split_atoms(F.col("c")), F.lit(False)), c="Blowout")) == ("E", None, None, None)
    assert tuple(one(spark, A.risk_matrix(A.split_atoms(F.col("c")), F.lit(False)), c="Fatality")) == (None, None, None, None)


def test_linkage_span_cap(spark):
    df = spark.createDataFrame([([0.0, 1.4, 2.8, 4.2, 5.6, 7.0],), ([10.0, 10.5],)], "v array<double>")
    rows = [[x["row"] for x in r.r] for r in df.select(ordered.linkage_rows(F.col("v"), 1.5, 2.0).alias("r")).collect()]
    assert rows == [[1, 1, 2, 2, 3, 3], [1, 1]]


def test_distribute_headers(spark):
    df = spark.createDataFrame([(["Head:", "- one", "- two", "plain", "- three", "Lone:"],), (["Only:"],)], "s array<string>")
    assert [r.x for r in df.select(ordered.distribute_headers(F.col("s")).alias("x")).collect()] == [["Head: one", "Head: two", "plain", "three", "Lone:"], ["Only:"]]


def test_water_fill():
    assert ordered.water_fill({"a": 100, "b": 2, "c": 50}, 30) == {"a": 14, "b": 2, "c": 14}
    assert ordered.water_fill({"a": 5, "b": 5}, 1) == {"a": 1, "b": 1}
    assert ordered.water_fill({}, 5) == {}


def test_hash_rank_is_a_total_order(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("i"))
    want = {k: n for n, k in enumerate(sorted(map(str, range(500)), key=lambda k: (hashlib.sha256(k.encode()).hexdigest(), k)), 1)}
    for parts in (1, 7):
        assert {r.i: r["rank"] for r in ordered.hash_rank(ids.repartition(parts), "i").collect()} == want


def test_two_tier_hit_with_null_does_not_fall_through(spark):
    left = spark.createDataFrame([(1, "d1", 600, "GC 1"), (2, "d1", 601, "GC 1"), (3, "d2", None, "GC 2"), (4, "d9", 1, "GC 9")], "id int, d string, m int, lease string")
    right = spark.createDataFrame([(1, "d1", 600, "GC 1", None), (2, "d1", 600, "GC 1", "late"), (3, "d2", 5, "GC 2", "two"), (4, "d2", 6, "GC 2", "later")], "ord int, d string, m int, lease string, v string")
    got = {r.id: (r.tier, r.v) for r in joins.two_tier_join(left, right, [("d", "m"), ("lease", "d")], "ord", ["v"]).collect()}
    assert got == {1: (1, None), 2: (2, None), 3: (2, "two"), 4: (None, None)}


def test_recurrences(spark):
    day = lambda n: date(2021, 1, n)
    rows = [(1, "g", day(1), day(3), ["3"]), (2, "g", day(3), day(4), ["3"]), (3, "g", day(5), None, ["3", "8"]), (4, "h", day(5), day(6), ["3"]), (5, "g", day(13), day(14), ["8"])]
    df = spark.createDataFrame(rows, "id int, g string, d date, c date, e array<string>")
    got = {(r.a, r.b) for r in joins.recurrences(df, "id", "g", "d", "c", "e", 10).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[3] and b[2] > a[3] and 0 <= (b[2] - a[2]).days <= 10 and (a[2], a[0]) < (b[2], b[0]) and set(a[4]) & set(b[4])}
    assert got == want and want


def test_provenance_invariants(spark):
    df = provenance.base_tokens(spark.createDataFrame([("1", "a"), ("2", " "), ("3", None)], "id string, v string"), ["id", "v"], keys=["id"])
    df = provenance.fill_gaps(df, "v", F.when(F.col("id") == "2", "x"), "xw")
    df = provenance.fill_gaps(df, "v", F.lit("s"), "syn")
    assert {(r.id, r.v, r.v__prov) for r in df.collect()} == {("1", "a", "src"), ("2", "x", "xw"), ("3", "s", "syn")}
    assert provenance.orphans(df, ["id", "v"], "id").count() == 0
    assert {r.id: r.v for r in provenance.real_only(df, ["v"]).collect()}["3"] == ""
    tally = {r.column: r for r in provenance.token_tally(df, ["id", "v"]).collect()}
    assert tally["id"].fabricated == 3 and (tally["v"].real, tally["v"].fabricated) == (2, 1)


@pytest.mark.parametrize(("value", "want"), [("", None), ("NAME OF FIELD x y z", "form_label"), ("two words", "too_short"), ("4 words here now", "bad_pattern"), ("Four words here now", "truncated"), ("Four words here now.", None)])
def test_first_failure(spark, value, want):
    rule = provenance.first_failure(F.col("v"), label_tokens=("NAME OF FIELD",), min_words=4, pattern="[A-Z].*", terminal=(".", "!", "?"))
    assert one(spark, rule, v=value) == want


def test_projection(spark):
    rules = [{"label": "What happened?  ", "kind": "text", "source": ["a", "b"]}, {"label": " Lease", "kind": "area_block", "source": ["c"]}, {"label": "Gone", "kind": "text", "source": ["nowhere"]}]
    df = spark.createDataFrame([(" ", " x  y ", "MC 012")], "a string, b string, c string")
    got = df.select(*compile_projection(rules, df.columns)).first().asDict()
    assert got == {"What happened?  ": "x y", " Lease": "MC 12", "Gone": ""}
    with pytest.raises(KeyError):
        compile_projection([{"label": "x"}], [])


def test_skip_needs_both(spark):
    """Blank leader alone, or no cause alone, is no skip."""
    i = spark.createDataFrame([(1, ""), (2, ""), (3, "x"), (4, "x")], "id int, leader string")
    c = spark.createDataFrame([(1,), (3,)], "id int")
    assert [r.id for r in i.filter("leader = ''").join(c, "id", "left_anti").collect()] == [2]


def test_files(spark, tmp_path):
    rows = [("1", 'quote " and, comma', "line\nbreak"), ("2", "", "é")]
    cols = ["id", " spaced ", "text"]
    files.write_csv(spark.createDataFrame(rows, "id string, ` spaced ` string, text string"), str(tmp_path / "c"), cols)
    back = files.read_csv(spark, str(tmp_path / "c"), cols)
    assert {tuple(r) for r in back.collect()} == set(rows)
    assert files.read_csv(spark, str(tmp_path / "none"), cols, missing_ok=True).count() == 0
    assert files.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "c")]) == str(tmp_path / "c")
    r = files.rules(spark, [{"pattern": "a", "value": 1}, {"pattern": "b", "value": 2}], ["pattern", "value"])
    assert [(x.ord, x.pattern) for x in r.orderBy("ord").collect()] == [(0, "a"), (1, "b")]
    with pytest.raises(KeyError):
        files.rules(spark, [{"pattern": "a"}], ["pattern", "value"])
    assert one(spark, files.typed(F.col("v"), "int"), v=" ") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, files.typed(F.col("v"), "int"), v="x1")


def test_zip(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("only.txt", "a,b")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    got = {r.path[-5:]: (r.member, r.text, r.error) for r in files.zip_members(spark.read.format("binaryFile").load(str(tmp_path / "*.zip")), "spine.txt").collect()}
    assert got == {"a.zip": ("only.txt", "a,b", None), "b.zip": (None, None, "not an archive")}


BOUNDS = (date(2021, 1, 1), date(2025, 12, 31))


def test_planted_pairs_follow_the_close_out_within_the_window():
    c = [scenario.Candidate(f"i{k}", date(2021, 6, 1 + k), 5 * k) for k in range(10)]
    spans = {x.ident: x.span for x in c}
    got = scenario.plant_pairs(c, 3, 40, "x", BOUNDS)
    assert [(p.first, p.second) for p in got] == [("i0", "i1"), ("i2", "i3"), ("i4", "i5")]
    assert all(spans[p.first] < (p.second_day - p.first_day).days < 40 for p in got)
    assert {x.ident: x.day for x in c}[got[0].second] == got[0].second_day
    assert all(p.element in scenario.PLANT_ELEMENTS and p.work_group in dict(scenario.WORK_GROUPS) for p in got)
    assert {p.work_group for p in scenario.plant_pairs(c, 2, 40, "x", BOUNDS, group="Drilling")} == {"Drilling"}
    # Spans of window - 1 and more are left out: i0 to i7 make four pairs, not five.
    with pytest.raises(ValueError, match="4 of 5"):
        scenario.plant_pairs(c, 5, 40, "x", BOUNDS)


def test_planted_pairs_move_back_from_the_end_or_are_given_up():
    late = lambda **more: [scenario.Candidate("a", BOUNDS[1], 10, **more), scenario.Candidate("b", BOUNDS[0], 10), scenario.Candidate("c", BOUNDS[0], 10)]
    (p,) = scenario.plant_pairs(late(), 1, 30, "x", BOUNDS)
    assert (p.first, p.second, p.second_day) == ("a", "b", BOUNDS[1]) and p.first_day < BOUNDS[1]
    c = late(back=3000)
    (p,) = scenario.plant_pairs(c, 1, 30, "x", BOUNDS)
    assert (p.first, p.second) == ("b", "a") and c[0].day == p.second_day
    with pytest.raises(ValueError, match="0 of 1"):
        scenario.plant_pairs([scenario.Candidate(x, BOUNDS[0], 1, ahead=5000) for x in "ab"], 1, 30, "x", BOUNDS)
    assert scenario.plant_pairs([], 0, 30, "x", BOUNDS) == []
    # The host draw equals the column builder's.
    assert scenario.host_draw(97, "x", "pairgap", 2) == int(hashlib.sha256(b"x|pairgap|2").hexdigest(), 16) % 97


def test_values_at_counts_ranks_exactly(spark):
    rng = random.Random(5)
    data = {"a": [rng.choice([1.0, 1.0, 2.5, 9.0]) for _ in range(101)], "b": [7.0], "c": [rng.uniform(-1e6, 1e6) for _ in range(3000)], "d": [4.0] * 50 + [rng.random() for _ in range(50)]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), (None, 3.0), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: (r.mid, r.high, r.least) for r in ordered.values_at(df, "g", "v", {"mid": lambda n: F.floor(n / 2), "high": lambda n: F.floor(F.lit(0.9) * (n - 1)), "least": lambda n: F.lit(0)}).collect()}
    assert got == {g: (sorted(vs)[len(vs) // 2], sorted(vs)[int(0.9 * (len(vs) - 1))], min(vs)) for g, vs in data.items()}
    assert ordered.values_at(df.filter("false"), "g", "v", {"mid": lambda n: F.floor(n / 2)}).collect() == []


def test_water_fill_sample_takes_the_first_by_hash(spark):
    sizes = {"a": 300, "b": 3, "c": 40}
    rows = [(f"{g}{i}", g, i) for g, n in sizes.items() for i in range(n)] + [("null", None, 1)]
    got = ordered.water_fill_sample(spark.createDataFrame(rows, "k string, g string, i int"), "g", "k", 60).collect()
    digest = lambda k: (hashlib.sha256(k.encode()).hexdigest(), k)
    want = {k for g, n in ordered.water_fill(sizes, 60).items() for k in sorted((r[0] for r in rows if r[1] == g), key=digest)[:n]}
    assert {r.k for r in got} == want and len(got) == 60 and set(got[0].asDict()) == {"k", "g", "i"}


def test_near_values_equal_all_pairs(spark):
    rng = random.Random(11)
    words = ["pump", "pumps", "valve", "gas", "a", "of", "leak", "x", "é", "gas leak"]
    vocab = {" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(250)} | {"p", "um", "a  b", "ab", "abs"}
    count = {v: rng.randint(1, 9) for v in vocab}

    def near(a, b):
        x, y = set(a.split(" ")), set(b.split(" "))
        return a in b or b in a or len(x & y) / len(x | y) >= 0.5

    want = {(a, b, min(count[a], count[b])) for a in vocab for b in vocab if a.encode() < b.encode() and near(a, b)}
    df = spark.createDataFrame([*count.items(), ("", 3), (None, 4)], "v string, n int")
    got = [tuple(r) for r in joins.near_values(df, "v", "n").collect()]
    assert set(got) == want and len(got) == len(want)



def test_register_lateness_follows_its_expectation(spark):
    k = scenario.Knobs()
    p = scenario.plan(spark.range(2000).select(F.col("id").cast("string").alias("id")), "id", "foundry", k)
    m = scenario.manifest(p, scenario.closeout(p), k)
    assert m["incidents"] == 2000 and abs(m["overdue_rate"] - m["expected_overdue_rate"]) < 0.04


def test_forms(spark):
    assert one(spark, R.section(F.col("t"), "LIST:", ["NOTE", "END"]), t="x LIST: a b END c NOTE d") == "a b"
    assert one(spark, R.section(F.col("t"), "LIST:", ["NOTE"]), t="nothing here") == "nothing here"
    assert one(spark, R.tail_from(F.col("t"), "SEQUENCE"), t="a SEQUENCE b") == "SEQUENCE b"
    assert one(spark, R.field_class(F.lit(None).cast("string"), ["n/a"])) == "parse_failed"
    for raw, want in (('{"category": "a", "element": 3}', ("a", 3)), ('{"category": "a", "element": 0}', None), ('{"category": "z", "element": 3}', None), ('x {"category": "none"} y', ("none", None)), ("", None)):
        got = one(spark, R.response(F.col("t"), ["a"], "none"), t=raw)
        assert (got and tuple(got)) == want


def test_nearest_labels(spark):
    words = spark.createDataFrame([(1, "Yes", 15.0, 25.0, 100.0), (1, "sir", 30.0, 40.0, 101.0), (1, "far", 60.0, 70.0, 100.0), (1, "other", 15.0, 25.0, 120.0)], "page int, text string, x0 double, x1 double, y double")
    marks = spark.createDataFrame([(1, 1, 5.0, 99.0), (1, 2, 5.0, 121.0)], "page int, mark int, x double, y double")
    assert {r.mark: r.label for r in layout.labels_of_marks(marks, words, "page").collect()} == {1: "Yes sir", 2: "other"}


def test_disjoint_matches(spark):
    d = spark.createDataFrame([(1, 0, 0, 5, "a"), (1, 1, 3, 8, "b"), (1, 2, 5, 9, "c"), (1, 3, 8, 10, "d")], "g int, priority int, start int, end int, what string")
    assert {r.what for r in layout.disjoint_matches(d, "g").collect()} == {"a", "c"}


def test_covering_bands(spark):
    rows = [(1, k, [(0.0, 290.0), (310.0, 600.0)] if k >= 4 else [(0.0, 600.0)], k % 3 == 0) for k in range(12)]
    d = spark.createDataFrame(rows, "page int, row long, spans array<struct<x0:double,x1:double>>, anchor boolean")
    assert [tuple(r) for r in layout.covering_bands(d, "page").collect()] == [(1, 290, 4, 11)]


def test_records(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "i int, v string")
    twin = spark.createDataFrame([(1, "src")], "i int, v string")
    with pytest.raises(Exception, match="differ in number"):
        records.with_twin(d, twin, "i", ["v"]).collect()
    with pytest.raises(Exception, match="unknown tag"):
        records.templates_by_tag(spark.createDataFrame([("x", 1, "t")], "tag string, id int, text string"), ["y"]).collect()
    assert records.numbered(["src_form", "src_f18_cause"], 18) == "src_f18_cause" and records.numbered(["src_f18x"], 18) is None
    assert records.label_columns([("g", ["a", "b"]), ("h", ["b", "c"])], ["k"], ["h", "g"]) == ["k", "b", "c", "a"]
    assert records.yaml_text({"b": {"x": [1, "two"]}, "a": None}) == '"b":\n  "x":\n    - 1\n    - "two"\n"a": null\n'
    files.write_csv(d.select(F.col("i").cast("string").alias(" i"), "v"), f"{tmp_path}/t.csv", [" i", "v"])
    assert records.header(spark, f"{tmp_path}/t.csv") == [" i", "v"]
    assert one(spark, X.without_head(F.col("t"), F.lit("Cause")), t="Cause - it fell") == "it fell"
    assert one(spark, X.without_head(F.col("t"), F.lit("Cause")), t="Causes: many") == "Causes: many"


def test_synthesis_of_absent_dates_types_and_damage(spark):
    rows = [
        ("a", "2024-05-02", ["Fire", None, " ", "Fire", "Pollution"], 25000.0, "GC 1", 1), ("b", "2026-08-01", [], None, None, 2), ("c", "2026-01-01", None, 600000.0, "GC 3", 3),
        ("d", " ", ["Fire"], 1.0, "GC 4", 4), ("e", None, ["Fire"], 1.0, "GC 5", 5), ("f", "2024-02-30", ["Fire"], 1.0, "GC 6", 6), ("g", "May 2, 2024", ["Fire"], 1.0, "GC 7", 7),
    ]
    df = spark.createDataFrame(rows, "id string, day string, types array<string>, damage double, site string, key int")
    out = synthesis.synthesize(df, "id", "day", "types", "damage", "site")
    got = {r.id: r for r in out.collect()}
    made = [c for c in out.columns if c.startswith("syn_")]
    assert len(made) == 28 and out.columns[:6] == df.columns and len(got) == 7
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.syn_incident_title, a.syn_incident_classification, a.syn_environment_reputation_score, a.syn_financial_score, a.syn_mitigated_risk_score) == ("Fire, Pollution incident at GC 1", "Serious", 5, 2, 3)
    assert (a.syn_action_status, a.syn_schedule_status, a.anomalies, a.skipped) == ("Completed", "N/A", [], None)
    digest = lambda salt: hashlib.sha256(f"a{salt}".encode()).hexdigest()
    assert a.syn_responsible_owner_name == f"SYN-Owner-{digest('owner')[:6]}"
    assert a.syn_date_of_report == date.fromordinal(date(2024, 5, 2).toordinal() + 5 + int(digest("date_of_report"), 16) % 11)
    assert a.syn_approval_date < a.syn_close_out_date and a.syn_approval_date < a.syn_action_due_date
    assert (b.syn_incident_classification, b.syn_hs_risk_score, b.syn_mitigated_risk_score, b.syn_environment_reputation_classification, b.syn_financial_classification) == ("Unknown", None, None, "Unknown", "Unknown")
    assert b.anomalies == ["unresolved_incident_classification", "unresolved_property_damage"] and b.syn_incident_title == "Unspecified incident at " and b.syn_action_status == "Pending"
    assert c.anomalies == ["unresolved_incident_classification"] and (c.syn_financial_classification, c.syn_action_status) == ("Major", "In Progress")
    assert {k: got[k].skipped for k in "defg"} == {"d": "no_incident_date", "e": "no_incident_date", "f": "unparseable_date", "g": "unparseable_date"}
    assert all(got[k][m] is None for k in "defg" for m in made)
    assert synthesis.synthesize(df.filter("false"), "id", "day", "types", "damage", "site").collect() == []


def test_a_manifest_asserts_every_kpi(spark):
    k = scenario.Knobs()
    p = scenario.plan(spark.range(60).select(F.col("id").cast("string").alias("i")), "i", "x", k)
    planted = [scenario.Planted("a", "b", date(2021, 1, 1), date(2021, 2, 1), "3", "Drilling")]
    detected = spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "e")], "a string, b string")
    plants = [scenario.Plant("report_lag", "median_report_lag", ">", ref="base", factor=3.0), scenario.Plant("recurrence", "recurrence_rate", ">=", count=1)]
    m = scenario.manifest(p, scenario.closeout(p), k, "x", plants, ["skip_rate"], planted, detected)
    assert m["analytic_expectations"]["recurrence_rate"] == 2 and m["window"] == {"start": "2021-01-01", "end": "2025-12-31"}
    assert m["plants"] == [{"pathology": "report_lag", "kpi": "median_report_lag", "op": ">", "ref": "base", "factor": 3.0}, {"pathology": "recurrence", "kpi": "recurrence_rate", "op": ">=", "count": 1, "affected_ids": [["a", "b"]]}]
    assert scenario.unasserted(m, ["median_report_lag", "skip_rate", "overdue_rate", "owner_completeness"]) == ["owner_completeness"]
    other = scenario.Knobs(skip=0.5)
    assert m["scenario_sha256"] != scenario.manifest(p, scenario.closeout(p), other)["scenario_sha256"] and len(m["scenario_sha256"]) == 64
    assert plants[0].holds(31, 10) and not plants[0].holds(30, 10) and plants[1].holds(1) and scenario.Plant("x", "y", "<", points=-25).holds(70, 96)


def test_colliding_keys_take_their_suffix(spark):
    rows = [(i, "hot", f"h{i}") for i in range(500)] + [(1000, "one", "h"), (1001, None, "h"), (1002, "two", "a"), (1003, "two", "a")]
    got = {r.i: r.k for r in joins.suffix_collisions(spark.createDataFrame(rows, "i int, k string, h string"), "k", "h", "i", salts=7).collect()}
    assert got == {i: f"hot-h{i}" for i in range(500)} | {1000: "one", 1001: None, 1002: "two-a", 1003: "two-a"}
