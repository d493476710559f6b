"""Rules over rows that differ: heads of statements, outcome sentences, projections with fallbacks, dispositions, misses."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions import text as X
from caseledger.functions.dates import chain_faults
from caseledger.operators.aggregates import conditional_rates
from caseledger.operators.harvest import plan_fetch
from caseledger.operators.joins import first_of
from caseledger.operators.provenance import disposition, orphans, prov, token_tally
from caseledger.plans.projection import compile_projection
from caseledger.queries.base import query

_MARKS = [": ", " - ", "- ", " – ", "-", " "]
_HEADS = ["Human Error", "Note", "LIST THE CAUSES", "Pump failure of the second kind in the yard", "worn seal", "OF ACCIDENT", "Flexi-Coil"]
#: The statements, in SQL of both engines.
_STATEMENT = f"""CASE p_partkey % 11 WHEN 0 THEN '' WHEN 1 THEN '• ' WHEN 2 THEN '(cid:3) ' ELSE '' END || CASE p_partkey % 13 WHEN 12 THEN '' ELSE CASE p_partkey % 7 {' '.join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(_HEADS))} END || CASE p_partkey % 6 {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MARKS))} END || p_name || ': ' || p_type END"""


@query(rf"""WITH s AS (SELECT p_partkey, {_STATEMENT} AS raw FROM part), b AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(raw, '\(cid:\d+\)', '•', 'g'), '^[\s•●▪·*-]+', '')) AS body FROM s),
m AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(body, '[:–—]', chr(1) || '\0'), '([a-zA-Z])-(\s)', '\1' || chr(2) || '\2'), '(\s)-(\s)', '\1' || chr(2) || '\2') AS marked FROM b),
c AS (SELECT *, CASE WHEN strpos(marked, chr(1)) = 0 AND strpos(marked, chr(2)) = 0 THEN 0 ELSE least(CASE WHEN strpos(marked, chr(1)) = 0 THEN 9999 ELSE strpos(marked, chr(1)) END, CASE WHEN strpos(marked, chr(2)) = 0 THEN 9999 ELSE strpos(marked, chr(2)) END) END AS spot FROM m),
h AS (SELECT *, trim(substr(body, 1, spot - 1), ' .–—-') AS head, substr(body, spot, 1) AS mark FROM c),
f AS (SELECT *, CASE WHEN body = '' THEN 'empty' WHEN spot = 0 OR spot > 61 OR NOT regexp_matches(head, '^[A-Z]') OR len(regexp_split_to_array(head, '\s+')) > 6 THEN 'untyped_prose' WHEN regexp_matches(head, '^(?i)(NOTE|LIST\s+THE.*)$') OR head = 'OF ACCIDENT' THEN 'furniture' WHEN mark = ':' THEN 'colon' ELSE 'dash' END AS form FROM h)
SELECT p_partkey, CASE WHEN form IN ('colon', 'dash') THEN head END AS head, form FROM f""")
def statement_forms(spark, t):
    """The head of every statement and how it was marked off; label text, prose and empty statements have none."""
    d = t("part").select("p_partkey", X.candidate_category(F.expr(_STATEMENT), fragments=["ACCIDENT", "OF ACCIDENT"]).alias("s"))
    return d.select("p_partkey", "s.head", "s.form")


_INJURY, _EVENT, _RESPONSE = {"fall": "a fall", "cut": "a cut"}, {"fire": "a fire", "spill": "a spill", "leak": "a leak"}, {"muster": "The crew Mustered", "shutdown": "wells were shut in"}
_ATOMS = {"spill": "o_orderkey % 2 = 0", "fire": "o_orderkey % 3 = 0", "leak": "o_orderkey % 7 = 0", "cut": "o_custkey % 4 = 0", "fall": "o_custkey % 5 = 0", "muster": "o_custkey % 3 = 0", "shutdown": "o_orderkey % 5 = 0"}


def _said(rules: dict[str, str]) -> str:
    found = "list_filter([" + ", ".join(f"CASE WHEN {_ATOMS[a]} THEN '{p}' END" for a, p in rules.items()) + "], lambda x: x IS NOT NULL)"
    return f"(SELECT CASE len(l) WHEN 0 THEN NULL WHEN 1 THEN l[1] ELSE array_to_string(l[1:len(l) - 1], ', ') || ' and ' || l[len(l)] END FROM (SELECT {found} AS l))"


@query(f"""WITH s AS (SELECT o_orderkey, 'The incident resulted in ' || {_said(_INJURY)} AS a, 'Reported as ' || {_said(_EVENT)} AS b, {_said(_RESPONSE)} AS c, CASE WHEN o_custkey % 6 = 0 THEN '' ELSE '$' || (o_totalprice::BIGINT // 1000) END AS damage FROM orders),
p AS (SELECT o_orderkey, damage, list_filter([a, b, upper(c[1]) || lower(c[2:])], lambda x: x IS NOT NULL) AS parts FROM s)
SELECT o_orderkey, CASE WHEN len(parts) = 0 THEN '' ELSE array_to_string(parts, '. ') || '.' || CASE WHEN damage = '' THEN '' ELSE ' Damage came to ' || damage || ' in all.' END END AS outcome FROM p""")
def outcome_texts(spark, t):
    """Sentences for injuries, events and responses in the rules' order, then the damage."""
    atoms = F.array_compact(F.array(*[F.when(F.expr(c), a) for a, c in _ATOMS.items()]))
    damage = F.when(F.col("o_custkey") % 6 == 0, "").otherwise(F.concat(F.lit("$"), F.floor(F.rint("o_totalprice") / 1000).cast("string")))
    return t("orders").select("o_orderkey", X.outcome_text(atoms, damage, _INJURY, _EVENT, _RESPONSE, "Damage came to {amount} in all.").alias("outcome"))


_PAGE = {
    "src_f04_lease": "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'AREA: GC BLOCK: ' || CAST(o_custkey AS VARCHAR(9)) WHEN 2 THEN 'BLOCK: none' ELSE 'AREA: grid' END",
    "src_f05_platform": "'A-' || CAST(o_custkey AS VARCHAR(9)) || CASE WHEN o_orderkey % 3 = 0 THEN ' RIG NAME: Deep ' || o_orderpriority ELSE ' :' END || chr(10) || 'second line'",
    "src_f07_type": "CASE WHEN o_orderkey % 5 < 2 THEN 'FIRE OTHER dropped load ' ELSE 'OTHER x1' END",
    "src_f17_findings": "CASE WHEN o_orderkey % 6 = 0 THEN 'AREA: MP BLOCK: 77 was named. ' ELSE '' END || 'It began well. The hand was flown to a hospital on day ' || CAST(o_custkey AS VARCHAR(9)) || CASE WHEN o_orderkey % 2 = 0 THEN '. He was flown to.' ELSE '. Done.' END",
    "src_area": "CASE WHEN o_orderkey % 7 = 0 THEN ' VK ' ELSE '' END",
}
_RULES = [
    {"label": "Site", "kind": "area", "source": ["src_f04_lease"], "whole_record": r"src_f\d{2}_", "manifest": ["src_area"]},
    {"label": "Block", "kind": "block", "source": ["src_f04_lease"], "whole_record": r"src_f\d{2}_"},
    {"label": "Platform", "kind": "platform", "source": ["src_f05_platform"]}, {"label": "Rig", "kind": "rig_name", "source": ["src_f05_platform"]},
    {"label": "Other", "kind": "other_text", "source": ["src_f07_type"]}, {"label": "Outcome", "kind": "last_sentence", "source": ["src_f17_findings"], "cue": "(?i)flown to"},
]


@query(f"""WITH p AS (SELECT o_orderkey, {', '.join(f'{v} AS {k}' for k, v in _PAGE.items())} FROM orders), w AS (SELECT *, concat_ws(' ', src_f04_lease, src_f05_platform, src_f07_type, src_f17_findings) AS whole FROM p)
SELECT o_orderkey, coalesce(nullif(regexp_extract(src_f04_lease, 'AREA:\\s*([A-Z]{{2,3}})\\b', 1), ''), nullif(regexp_extract(whole, 'AREA:\\s*([A-Z]{{2,3}})\\b', 1), ''), trim(src_area)) AS "Site",
coalesce(nullif(regexp_extract(src_f04_lease, 'BLOCK:\\s*(\\d{{1,4}})\\b', 1), ''), regexp_extract(whole, 'BLOCK:\\s*(\\d{{1,4}})\\b', 1)) AS "Block", 'A-' || o_custkey AS "Platform", CASE WHEN o_orderkey % 3 = 0 THEN 'Deep ' || o_orderpriority ELSE '' END AS "Rig",
CASE WHEN o_orderkey % 5 < 2 THEN 'dropped load' ELSE '' END AS "Other", CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'The hand was flown to a hospital on day ' || o_custkey || '.' END AS "Outcome" FROM w JOIN orders USING (o_orderkey)""")
def record_projection(spark, t):
    """Form records through extractor kinds, the whole record and the manifest standing in for an unreadable field."""
    d = t("orders").select("o_orderkey", *[F.expr(v).alias(k) for k, v in _PAGE.items()])
    return d.select("o_orderkey", *compile_projection(_RULES, d.columns))


_GRID = {"c_name": "CASE WHEN c_custkey % 5 = 0 THEN 'syn' WHEN c_custkey % 5 = 1 THEN 'xw' ELSE 'src' END", "c_mktsegment": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'llm' END", "c_phone": "CASE WHEN c_nationkey % 2 = 0 THEN 'pseud' ELSE 'src' END", "c_key": "'key'"}


@query(f"""WITH g AS (SELECT {', '.join(f'{v} AS {k}' for k, v in _GRID.items())} FROM customer), l AS (UNPIVOT g ON {', '.join(_GRID)} INTO NAME "column" VALUE token),
m AS (SELECT "column", 'measured' AS basis, count_if(token IN ('src', 'xw')) AS "real", count_if(token = 'pseud') AS pseud, count_if(token IN ('syn', 'llm', 'key')) AS fabricated, count(*) AS total FROM l GROUP BY 1),
n AS (SELECT count(*) AS n FROM customer), d AS (SELECT * FROM m UNION ALL SELECT 'c_comment', 'declared', n * 2 // 5, 0, n // 5, n FROM n UNION ALL SELECT 'c_empty', 'declared', 0, 0, 0, 0 FROM n),
s AS (SELECT "column", basis, "real"::BIGINT AS "real", pseud::BIGINT AS pseud, fabricated::BIGINT AS fabricated, total::BIGINT AS total, (total - "real" - pseud - fabricated)::BIGINT AS unfilled, round(CASE WHEN total = 0 THEN 0 ELSE "real" / total END, 6)::DOUBLE AS real_share FROM d)
SELECT *, CASE WHEN real_share < 0.5 THEN row_number() OVER (ORDER BY real_share >= 0.5, real_share, "column") END::INTEGER AS target FROM s""")
def disposition_targets(spark, t):
    """What every column holds: measured from tokens, else declared; the columns short of the goal in order of need."""
    c = t("customer").select(*[F.expr(v).alias(prov(k)) for k, v in _GRID.items()])
    declared = t("customer").agg(F.count("*").alias("n")).select(F.explode(F.array(
        F.struct(F.lit("c_comment").alias("column"), F.floor(F.col("n") * 2 / 5).alias("real"), F.lit(0).cast("long").alias("pseud"), F.floor(F.col("n") / 5).alias("fabricated"), F.col("n").alias("total")),
        F.struct(F.lit("c_empty").alias("column"), *[F.lit(0).cast("long").alias(x) for x in ("real", "pseud", "fabricated", "total")]),
        F.struct(F.lit("c_name").alias("column"), *[F.lit(1).cast("long").alias(x) for x in ("real", "pseud", "fabricated", "total")]),
    )).alias("x")).select("x.*")
    return disposition(token_tally(c, list(_GRID)), declared, 0.5)


@query("SELECT o_orderkey, 'value' AS \"column\" FROM orders WHERE o_orderkey % 10 IN (1, 2, 3)")
def provenance_faults(spark, t):
    """Cells whose token does not fit: a value without one, a blank with one, an unknown one."""
    k = F.col("o_orderkey") % 10
    d = t("orders").select("o_orderkey", F.when(k.isin(2, 4), " ").otherwise(F.col("o_orderpriority")).alias("value"), F.when(k.isin(1, 4), "").when(k == 3, "guess").otherwise("src").alias(prov("value")))
    return orphans(d, ["value"], "o_orderkey")


@query("SELECT mechanism, count(*) AS n, round(avg(hurt), 6) AS rate FROM (SELECT DISTINCT o_orderkey, unnest([o_orderpriority, o_orderstatus]) AS mechanism, (o_totalprice > 150000)::INTEGER AS hurt FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1996) GROUP BY 1 HAVING count(*) >= 20")
def conditional_rate_window(spark, t):
    """How often a mechanism's rows of 1993 to 1996 come to harm."""
    d = t("orders").select(F.array("o_orderpriority", "o_orderstatus", "o_orderstatus").alias("m"), (F.col("o_totalprice") > 150000).alias("hurt"), F.year("o_orderdate").alias("y"))
    return conditional_rates(d, "m", "hurt", "y", 1993, 1996)


@query("SELECT c_nationkey AS nationkey, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY 1")
def registry_misses(spark, t):
    """Keys that a registry of three regions' nations does not know, with how often they are asked for."""
    known = t("nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"))
    return t("customer").join(F.broadcast(known), "c_nationkey", "left_anti").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("n"))


@query("SELECT p_name AS name, count(*) AS n, string_agg(p_partkey, ',' ORDER BY p_partkey) AS keys FROM part GROUP BY 1 HAVING count(*) > 1")
def inverse_conflicts(spark, t):
    """Values that an inverse map cannot take back to one key."""
    return t("part").groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("p_partkey")).cast("array<string>"), ",").alias("keys")).filter("n > 1")


_WANTED = "SELECT page_id, CASE WHEN page_id % 9 = 0 THEN ' ' ELSE url END AS a, CASE WHEN page_id % 18 = 0 THEN NULL ELSE 'https://mirror.example/' || page_id END AS b, sha256(html) AS sha FROM pages"
_HELD = "SELECT page_id - page_id % 2 AS page_id, page_id AS turn, sha256(html) AS held_sha FROM pages WHERE page_id % 5 <> 0"


@query(f"""WITH w AS ({_WANTED}), h AS (SELECT page_id, arg_max(held_sha, turn) AS held_sha FROM ({_HELD}) GROUP BY 1), u AS (SELECT w.*, h.held_sha, coalesce(nullif(trim(a), ''), nullif(trim(b), '')) AS url FROM w LEFT JOIN h USING (page_id))
SELECT page_id, url, CASE WHEN url IS NULL THEN 'no_url' WHEN held_sha IS NULL THEN 'fetch' WHEN held_sha = sha THEN 'skip' ELSE 'mismatch' END AS action FROM u""")
def fetch_actions(spark, t):
    """Pages against a manifest whose last row of a key counts: some pages are held, some hold what another one had."""
    digest = F.sha2(F.col("html").cast("binary"), 256)
    k = F.col("page_id")
    wanted = t("pages").select("page_id", F.when(k % 9 == 0, " ").otherwise(F.col("url")).alias("a"), F.when(k % 18 != 0, F.concat(F.lit("https://mirror.example/"), k.cast("string"))).alias("b"), digest.alias("sha"))
    held = t("pages").filter(k % 5 != 0).select((k - k % 2).alias("page_id"), (-k).alias("turn"), digest.alias("held_sha"))
    return plan_fetch(wanted, first_of(held, ["page_id"], F.col("turn")), "page_id", ["a", "b"])


@query("SELECT CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS split, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, 'texts of ' || min(n_chars) || ' to ' || max(n_chars) || ' characters' AS rationale FROM documents GROUP BY 1")
def split_counts(spark, t):
    """Each split with its number of documents, their range and the reason of the split."""
    d = t("documents").groupBy(F.when(F.col("n_chars") < 500, "short").otherwise("long").alias("split"))
    why = F.concat(F.lit("texts of "), F.min("n_chars").cast("string"), F.lit(" to "), F.max("n_chars").cast("string"), F.lit(" characters"))
    return d.agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), why.alias("rationale"))


@query("""WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS incident, o_orderdate::DATE + (o_custkey % 9)::INTEGER - 2 AS report, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderdate::DATE + (o_orderkey % 11)::INTEGER END AS closed FROM orders)
SELECT * FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN report < incident THEN 'report<incident' END, CASE WHEN closed < report THEN 'closed<report' END) AS faults FROM d) WHERE faults <> ''""")
def date_chain_faults(spark, t):
    """Orders read as incidents whose dates stand in the wrong order."""
    day = F.col("o_orderdate").cast("date")
    d = t("orders").select("o_orderkey", day.alias("incident"), F.date_add(day, (F.col("o_custkey") % 9 - 2).cast("int")).alias("report"), F.when(F.col("o_orderkey") % 8 != 0, F.date_add(day, (F.col("o_orderkey") % 11).cast("int"))).alias("closed"))
    return d.select("o_orderkey", F.array_join(chain_faults([("report", "incident"), ("closed", "report")]), ",").alias("faults")).filter("faults <> ''")


@query(r"SELECT doc_id, CASE WHEN length(x) > 0 AND (length(x) - length(regexp_replace(x, '\(cid:\d+\)', '', 'g'))) / length(x) > 0.05 THEN 'text_layer_unmapped' ELSE 'ok' END AS status FROM (SELECT doc_id, text || repeat('(cid:7)', (doc_id % 9)::INTEGER * 4) AS x FROM documents)")
def text_layer_status(spark, t):
    """Texts of which glyph codes make up more than a twentieth cannot be used."""
    x = F.concat("text", F.repeat(F.lit("(cid:7)"), (F.col("doc_id") % 9).cast("int") * 4))
    return t("documents").select("doc_id", F.when(X.glyph_share(x) > 0.05, "text_layer_unmapped").otherwise("ok").alias("status"))
