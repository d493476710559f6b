"""Atoms, prefixes, patterns, statements, dates and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions import atoms as A
from caseledger.functions import dates as D
from caseledger.functions import text as X
from caseledger.functions.hashing import draw
from caseledger.operators.joins import longest_prefix, ordered_pattern
from caseledger.plans.projection import compile_projection
from caseledger.queries.base import query, sql_mod

_ATOMS = ("Fatality", "Injury", "Fire", "Explosion", "Crane", "Pollution", "LTA >3 days", "Incident >$25K")
_ATOM_SQL = "[" + ", ".join(f"'{a}'" for a in _ATOMS) + "]"
_CELL_SQL = f"""WITH o AS (SELECT o_orderkey, o_orderpriority LIKE '1%' AS crewed, {sql_mod("'atoms|' || o_orderkey", 512)} AS r FROM orders),
a AS (SELECT *, ({_ATOM_SQL})[r % 8 + 1] AS x, ({_ATOM_SQL})[(r // 8) % 8 + 1] AS y, r // 64 AS z FROM o), c AS (SELECT *, CASE WHEN z = 0 THEN [] WHEN z < 4 THEN [x] ELSE [x, y] END AS atoms FROM a)"""


def _cells(t):
    """Cells such as `` - Fire - Injury``, drawn by hash."""
    names = F.array(*[F.lit(a) for a in _ATOMS])
    r = draw(512, F.lit("atoms"), F.col("o_orderkey"))
    d = t("orders").select("o_orderkey", F.col("o_orderpriority").startswith("1").alias("crewed"), r.alias("r"))
    x, y, z = F.element_at(names, (F.col("r") % 8 + 1).cast("int")), F.element_at(names, (F.floor(F.col("r") / 8) % 8 + 1).cast("int")), F.floor(F.col("r") / 64)
    cell = F.when(z == 0, "").when(z < 4, F.concat(F.lit(" - "), x)).otherwise(F.concat_ws(" - ", x, y))
    return d.select("o_orderkey", "crewed", A.split_atoms(cell).alias("atoms"))


@query(_CELL_SQL + " SELECT o_orderkey, len(atoms)::INTEGER AS n, array_to_string(atoms, ';') AS atoms FROM c")
def atom_split(spark, t):
    return _cells(t).select("o_orderkey", F.size("atoms").alias("n"), F.array_join("atoms", ";").alias("atoms"))


_RANK = {"Fatality": 0, "Injury": 1, "LTA >3 days": 1, "Pollution": 2, "Incident >$25K": 4}
_RANK_SQL = "CASE {} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _RANK.items()) + " ELSE 5 END"


@query(_CELL_SQL + f" SELECT o_orderkey, CASE WHEN len(atoms) = 0 THEN NULL WHEN len(atoms) = 1 OR {_RANK_SQL.format('atoms[1]')} <= {_RANK_SQL.format('atoms[2]')} THEN atoms[1] ELSE atoms[2] END AS top FROM c")
def atom_precedence(spark, t):
    return _cells(t).select("o_orderkey", A.top_atom(F.col("atoms"), A.PRECEDENCE).alias("top"))


def _case(value: str, table: dict) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN {repr(v)}" for k, v in table.items()) + " END"


@query(_CELL_SQL + f""", m AS (SELECT o_orderkey, crewed, list_max(list_transform(atoms, lambda q: {_case('q', A.ENERGY)})) AS worst, list_max(list_transform(atoms, lambda q: {_case('q', A.FLOOR)})) AS flo,
 list_max(list_transform(atoms, lambda q: ({_case('q', A.RATES)})::DOUBLE)) AS rate FROM c),
n AS (SELECT o_orderkey, CASE WHEN worst IS NULL THEN NULL ELSE greatest(CASE WHEN crewed AND worst < 'E' THEN chr(ascii(worst) + 1) ELSE worst END, coalesce(flo, 'A')) END AS cons,
 CASE WHEN worst IS NULL OR rate IS NULL THEN NULL WHEN rate >= 0.2 THEN 5 WHEN rate >= 0.1 THEN 4 WHEN rate >= 0.05 THEN 3 WHEN rate >= 0.01 THEN 2 ELSE 1 END AS lik FROM m)
SELECT o_orderkey, coalesce(cons, '') AS consequence, coalesce(lik, 0)::INTEGER AS likelihood, coalesce(lik * (ascii(cons) - 64), 0)::INTEGER AS score,
 coalesce(CASE WHEN lik * (ascii(cons) - 64) >= 21 THEN 'Very Serious Incident' WHEN lik * (ascii(cons) - 64) >= 11 THEN 'Serious Incident' WHEN lik * (ascii(cons) - 64) >= 1 THEN 'Incident' END, '') AS class FROM n""")
def risk_matrix(spark, t):
    d = _cells(t).select("o_orderkey", A.risk_matrix(F.col("atoms"), F.col("crewed")).alias("m"))
    none = F.lit("")
    return d.select("o_orderkey", F.coalesce("m.consequence", none).alias("consequence"), F.coalesce("m.likelihood", F.lit(0)).alias("likelihood"), F.coalesce("m.score", F.lit(0)).alias("score"), F.coalesce("m.class", none).alias("class"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 25000 THEN 'A' WHEN o_totalprice < 100000 THEN 'B' WHEN o_totalprice < 1000000 THEN 'C' WHEN o_totalprice < 10000000 THEN 'D' ELSE 'E' END AS band FROM orders")
def band_lookup(spark, t):
    return t("orders").select("o_orderkey", A.ceiling_band(F.col("o_totalprice"), ((25000, "A"), (100000, "B"), (1000000, "C"), (10000000, "D"), (None, "E"))).alias("band"))


_PHRASES = (("Injury", "a person was hurt"), ("Fatality", "a person died"), ("Fire", "a fire"), ("Explosion", "an explosion"), ("Pollution", "a spill"))


@query(_CELL_SQL + ", p AS (SELECT o_orderkey, list_filter([" + ", ".join(f"CASE WHEN list_contains(atoms, '{a}') THEN '{p}' END" for a, p in _PHRASES) + """], lambda q: q IS NOT NULL) AS s FROM c)
SELECT o_orderkey, CASE len(s) WHEN 0 THEN '' WHEN 1 THEN s[1] ELSE array_to_string(s[1:len(s) - 1], ', ') || ' and ' || s[len(s)] END AS sentence FROM p""")
def outcome_sentence(spark, t):
    """Clauses in the rules' order, whatever the atoms' order."""
    parts = F.filter(F.array(*[F.when(F.array_contains("atoms", a), p) for a, p in _PHRASES]), lambda x: x.isNotNull())
    return _cells(t).select("o_orderkey", X.clause_list(parts).alias("sentence"))


_PREFIXES = ("a", "an", "al", "almond", "b", "bl", "blue", "s", "st", "steel", "g", "gr", "green", "l")


@query("SELECT p_partkey, (SELECT max(p) FROM (SELECT unnest([" + ", ".join(f"'{p}'" for p in _PREFIXES) + "]) AS p) WHERE starts_with(lower(p_name), p) AND length(p) = (SELECT max(length(q)) FROM (SELECT unnest([" + ", ".join(f"'{p}'" for p in _PREFIXES) + "]) AS q) WHERE starts_with(lower(p_name), q))) AS prefix FROM part")
def longest_prefix_match(spark, t):
    return t("part").select("p_partkey", longest_prefix(F.lower("p_name"), _PREFIXES).alias("prefix"))


_RULES = (("brass", "metal"), ("polished", "finish"), ("small", "size"), ("e", "other"))


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN contains(lower(p_type), '{a}') THEN '{b}'" for a, b in _RULES) + " END AS rule FROM part")
def ordered_pattern_match(spark, t):
    return t("part").select("p_partkey", ordered_pattern(F.col("p_type"), _RULES).alias("rule"))


_ALIASES = {"automobile": 15, "building": 3, "furniture": 8, "machinery": 9}


@query("SELECT c_custkey, " + _case("regexp_replace(trim(lower(c_mktsegment)), '[^a-z0-9 /]', '', 'g')", _ALIASES) + " AS element FROM customer WHERE lower(c_mktsegment) IN (" + ", ".join(f"'{a}'" for a in _ALIASES) + ")")
def alias_lookup(spark, t):
    """Normalised head against a rule table of the plan; misses are left out here."""
    rules = spark.createDataFrame(list(_ALIASES.items()), "head string, element int")
    return t("customer").select("c_custkey", X.normalise_head(F.col("c_mktsegment")).alias("head")).join(F.broadcast(rules), "head").select("c_custkey", "element")


@query("SELECT p_partkey, regexp_replace(trim(regexp_replace(lower('  ' || p_type || ' & Co_2'), '[\\s_]+', ' ', 'g')), '[^a-z0-9 /]', '', 'g') AS head FROM part")
def normalise_head(spark, t):
    return t("part").select("p_partkey", X.normalise_head(F.concat(F.lit("  "), F.col("p_type"), F.lit(" & Co_2"))).alias("head"))


@query("SELECT p_partkey, p_brand AS category, p_type AS subcategory, p_type || '. ' || p_name AS description FROM part")
def parse_head_sub_desc(spark, t):
    """Statements built as ``Head: sub. text`` come apart again."""
    s = X.parse_statement(F.concat(F.col("p_brand"), F.lit(": "), F.col("p_type"), F.lit(". "), F.col("p_name")))
    return t("part").select("p_partkey", s.alias("s")).select("p_partkey", "s.category", "s.subcategory", "s.description")


_ITEMS = 'CASE conv_id % 4 WHEN 0 THEN role WHEN 1 THEN \'1. \' || role || chr(10) || \'2) item \' || CAST(turn AS VARCHAR(9)) WHEN 2 THEN \'None.\' ELSE \'- one\' || chr(10) || \' a) \' || role || chr(10) || \'goes on\' || chr(10) || \'• last  \' || CAST(conv_id AS VARCHAR(9)) END'


@query("SELECT conv_id, turn, (CASE conv_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE 3 END)::INTEGER AS n, CASE conv_id % 4 WHEN 0 THEN role WHEN 1 THEN role WHEN 3 THEN 'one' END AS first, CASE conv_id % 4 WHEN 0 THEN role WHEN 1 THEN 'item ' || turn WHEN 3 THEN 'last ' || conv_id END AS last FROM conversations")
def split_enumerated(spark, t):
    """Lists with numbers, letters, bullets, one item or none."""
    items = X.split_enumerated(F.expr(_ITEMS))
    return t("conversations").select("conv_id", "turn", F.size(items).alias("n"), F.try_element_at(items, F.lit(1)).alias("first"), F.try_element_at(items, F.lit(-1)).alias("last"))


@query("SELECT event_id, (hour(ts) * 60 + minute(ts))::INTEGER AS minutes FROM events")
def minutes_since_midnight(spark, t):
    return t("events").select("event_id", D.minutes(F.date_format("ts", "HH:mm")).alias("minutes"))


@query("SELECT o_orderkey, CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN strftime(o_orderdate, '%Y') || '-02-31' WHEN 2 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def iso_from_text(spark, t):
    """DD-MON-YYYY in running text to ISO, unchecked against the calendar; an unknown or lower-case month gives a blank."""
    day, m = F.date_format("o_orderdate", "d-MMM-yyyy"), F.col("o_custkey") % 5
    text = F.when(m == 0, F.concat(F.lit("01-FOO-"), F.year("o_orderdate").cast("string"))).when(m == 1, F.concat(F.lit("31-FEB-"), F.year("o_orderdate").cast("string"))).when(m == 2, day).otherwise(F.upper(day))
    return t("orders").select("o_orderkey", D.iso_text(F.concat(F.lit("on "), text, F.lit(" at night"))).alias("day"))


@query("SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS us, o_orderdate::DATE::VARCHAR AS iso FROM orders")
def date_forms(spark, t):
    d = F.col("o_orderdate").cast("date")
    return t("orders").select("o_orderkey", D.to_date(F.date_format(d, "M/d/yyyy")).cast("string").alias("us"), D.to_date(F.date_format(d, "yyyy-M-d")).cast("string").alias("iso"))


#: Date, the one it rests on, least and most days between them (fixed rule values).
_CHAIN = (
    ("date_of_report", "incident_date", 5, 15), ("approval_date", "date_of_report", 14, 45), ("close_out_date", "approval_date", 30, 90),
    ("action_due_date", "approval_date", 30, 180), ("agreed_completion_date", "approval_date", 30, 180),
)
_CHAIN_SQL = "SELECT o_orderkey, o_orderdate::DATE AS incident_date FROM orders"
for _name, _base, _low, _high in _CHAIN:
    _CHAIN_SQL = f"SELECT *, {_base} + ({_low} + {sql_mod(f'{chr(39)}{_name}|{chr(39)} || o_orderkey', _high - _low + 1)})::INTEGER AS {_name} FROM ({_CHAIN_SQL})"


@query(f"SELECT o_orderkey, {', '.join(f'{n}::DATE::VARCHAR AS {n}' for n, *_ in _CHAIN)} FROM ({_CHAIN_SQL})")
def date_chain(spark, t):
    """Each date rests on an earlier one, with offsets drawn by hash."""
    d = t("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("incident_date"))
    for name, base, low, high in _CHAIN:
        d = d.withColumn(name, F.date_add(base, (F.lit(low) + draw(high - low + 1, F.lit(name), F.col("o_orderkey"))).cast("int")))
    return d.select("o_orderkey", *[F.col(n).cast("string").alias(n) for n, *_ in _CHAIN])


@query("SELECT o_orderkey, CASE WHEN date_diff('day', o_orderdate::DATE, DATE '1998-08-09') > 730 THEN 'Completed' WHEN date_diff('day', o_orderdate::DATE, DATE '1998-08-09') > 183 THEN 'In Progress' ELSE 'Pending' END AS status FROM orders")
def status_by_age(spark, t):
    return t("orders").select("o_orderkey", D.status_by_age(F.col("o_orderdate").cast("date"), F.lit("1998-08-09").cast("date")).alias("status"))


@query("SELECT o_orderkey, 'seen ' || strftime(o_orderdate + INTERVAL 45 DAY, '%Y-%m-%d') || ' and 2001-99-99, then ' || strftime(o_orderdate + INTERVAL 46 DAY, '%Y-%m-%d') || '.' AS text FROM orders")
def shift_dates_in_text(spark, t):
    day = F.col("o_orderdate").cast("date")
    text = F.concat(F.lit("seen "), F.date_format(day, "yyyy-MM-dd"), F.lit(" and 2001-99-99, then "), F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("."))
    return t("orders").select("o_orderkey", D.shift_iso_dates(text, 45).alias("text"))


@query("SELECT o_orderkey, (o_custkey % 3 + 1)::INTEGER AS n, CASE o_custkey % 3 WHEN 0 THEN o_orderdate::DATE ELSE o_orderdate::DATE + 2 END::VARCHAR AS first FROM orders")
def find_dates_in_text(spark, t):
    """Up to three dates of different forms among what only looks like one; forms are looked for in a fixed order."""
    from caseledger.functions.prose import prose_dates

    m, day = F.col("o_custkey") % 3, F.col("o_orderdate")
    text = F.concat_ws(" ", F.lit("on"), F.date_format(day, "yyyy-MM-dd"), F.lit("not 2001-13-40 or 31 June 2020,"), F.when(m > 0, F.date_format(F.date_add(day, 2), "MMMM d, yyyy")), F.when(m > 1, F.date_format(F.date_add(day, 1), "M/d/yyyy")))
    found = prose_dates(text)
    return t("orders").select("o_orderkey", F.size(found).alias("n"), F.element_at(found, 1).alias("first"))


@query("SELECT o_orderkey, 'Between ' || strftime(d, '%B %-d, %Y') || ' and ' || strftime(d, '%-m/%-d/%Y') || ' or ' || upper(strftime(d, '%d-%b-%Y')) AS text FROM (SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY AS d FROM orders)")
def shift_prose_dates(spark, t):
    """Date formats rewritten in place, format kept; by an Arrow UDF, since SQL has no callback replacement."""
    from caseledger.functions.prose import shift_prose_dates as shift

    text = F.concat_ws(" ", F.lit("Between"), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("and"), F.date_format("o_orderdate", "M/d/yyyy"), F.lit("or"), F.date_format("o_orderdate", "dd-MMM-yyyy"))
    return t("orders").select("o_orderkey", shift(text, F.lit(30)).alias("text"))


@query("SELECT doc_id, regexp_extract(text, '\\$\\s*([\\d,]+(\\.\\d{1,2})?)', 1) <> '' AS has_money, regexp_matches(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+') AS has_email FROM documents")
def email_money_scan(spark, t):
    return t("documents").select("doc_id", (F.regexp_extract("text", r"\$\s*([\d,]+(\.\d{1,2})?)", 1) != "").alias("has_money"), F.col("text").rlike("[A-Za-z0-9._-]+@[A-Za-z0-9.-]+").alias("has_email"))


@query("SELECT o_orderkey, floor(o_totalprice)::BIGINT::DOUBLE AS amount FROM orders")
def money_parse(spark, t):
    return t("orders").select("o_orderkey", X.money(F.concat(F.lit("cost $ "), F.format_number(F.floor("o_totalprice"), 0), F.lit(" in all"))).alias("amount"))


@query("SELECT o_orderkey, 'GC ' || (o_custkey % 900 + 1) AS lease FROM orders")
def area_block_parse(spark, t):
    return t("orders").select("o_orderkey", X.area_block(F.concat(F.lit("at GC-"), F.lpad((F.col("o_custkey") % 900 + 1).cast("string"), 5, "0"), F.lit(" well"))).alias("lease"))


@query(r"SELECT doc_id, round(coalesce((length(x) - length(regexp_replace(x, '\(cid:\d+\)', '', 'g')))::DOUBLE / nullif(length(x), 0), 0.0), 6)::DOUBLE AS share FROM (SELECT doc_id, text || '(cid:1)' AS x FROM documents)")
def cid_share(spark, t):
    """Share of a text's characters that unmapped glyph codes make up."""
    return t("documents").select("doc_id", F.round(X.glyph_share(F.concat("text", F.lit("(cid:1)"))), 6).alias("share"))


@query("SELECT page_id, count(*) AS links, count(DISTINCT href)::BIGINT AS distinct_links FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages) GROUP BY 1")
def html_links(spark, t):
    return t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href")).groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("href").alias("distinct_links"))


@query("""SELECT page_id, 'https://' || CASE page_id % 3 WHEN 1 THEN 'live.example' ELSE 'site.example' END || '/a%20b/' || page_id || '.pdf' AS fetch,
'https://' || CASE page_id % 3 WHEN 1 THEN 'live.example' ELSE 'site.example' END || '/a b/' || page_id || '.pdf' AS display, page_id % 3 = 1 AS canonicalised FROM pages""")
def url_canonicalise(spark, t):
    """Bare, dead-host and encoded links, all joined to the site's root."""
    from caseledger.functions.prose import resolve_url

    name, m = F.concat(F.col("page_id").cast("string"), F.lit(".pdf")), F.col("page_id") % 3
    href = F.when(m == 0, F.concat(F.lit(" a b/"), name)).when(m == 1, F.concat(F.lit("http://dead.example/a%20b/"), name)).otherwise(F.concat(F.lit("/a%20b/"), name))
    return t("pages").select("page_id", resolve_url(href, "https://site.example/", ("dead.example",), "live.example").alias("u")).select("page_id", "u.*")


@query("""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS a, (o_orderdate + INTERVAL 40 DAY)::DATE AS b, (o_orderdate + INTERVAL 400 DAY)::DATE AS c FROM orders)
SELECT o_orderkey, c || ';' || b || ';' || a AS dates FROM o""")
def find_prose_dates(spark, t):
    """Dates of several written forms in one text, whatever their letters' case; impossible ones are none."""
    from caseledger.functions.prose import prose_dates

    a, b, c = (F.date_add(F.col("o_orderdate").cast("date"), k) for k in (0, 40, 400))
    text = F.concat(F.lit("on "), F.date_format(a, "yyyy-MM-dd"), F.lit(" and "), F.date_format(b, "dd-MMM-yyyy"), F.lit(", 31/31/2020, "), F.lower(F.date_format(c, "MMMM d, yyyy")), F.lit("."))
    return t("orders").select("o_orderkey", F.array_join(prose_dates(text), ";").alias("dates"))


@query()
def html_year_rows(spark, t):
    """Table rows of linked years from index pages, by the standard library's parser in an Arrow stage."""
    from caseledger.sources.html import index_rows

    pages = t("pages").select("page_id", F.concat(F.lit("<h2>2021</h2><table><tr><td><a href='/a.pdf'>A</a></td><td>x&nbsp;y</td></tr><tr><td>no link</td></tr></table><h2>2022</h2>"), F.col("html")).alias("html"))
    return index_rows(pages, "page_id", "html")


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events WHERE (props->>'k')::BIGINT BETWEEN 1 AND 20")
def strict_json_parse(spark, t):
    """An integer member inside its range, or the row is discarded; JSON booleans and strings are no integers."""
    raw = F.get_json_object("props", "$.k")
    k = F.when(raw.rlike(r"^-?\d+$"), F.from_json("props", "k bigint")["k"])
    return t("events").select("event_id", k.alias("k")).filter(F.col("k").between(1, 20))


@query("SELECT o_orderkey::VARCHAR AS \"Incident Number\", strftime(o_orderdate, '%Y-%m-%d') AS \" Date\", CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE '' END AS \"Status  \" FROM orders")
def rule_projection(spark, t):
    """A projection compiled from rules: byte-exact labels, extractor kinds, fallbacks."""
    rules = [
        {"label": "Incident Number", "kind": "text", "source": ["o_orderkey"]},
        {"label": " Date", "kind": "date", "source": ["missing", "d"]},
        {"label": "Status  ", "kind": "literal_if", "source": ["o_orderstatus"], "pattern": "^F$", "literal": "Closed"},
    ]
    d = t("orders").withColumn("d", F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")))
    return d.select(*compile_projection(rules, d.columns))


@query("SELECT conv_id, turn, CASE WHEN length(text) > 600 THEN 'long' ELSE 'ok' END AS guard FROM conversations")
def length_guard(spark, t):
    return t("conversations").select("conv_id", "turn", F.when(F.length("text") > 600, "long").otherwise("ok").alias("guard"))


@query("SELECT o_orderkey, 'GC' AS area, (o_custkey % 900)::VARCHAR AS block, o_orderdate::DATE::VARCHAR AS day, TRUE AS redacted, '' AS notes FROM orders")
def filename_parse(spark, t):
    """Area, block, date and notes out of report file names, never raising."""
    from caseledger.functions.prose import parse_filename

    name = F.concat(F.lit("GC "), (F.col("o_custkey") % 900).cast("string"), F.lit(" "), F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")), F.lit(" Acme_Redacted.pdf"))
    return t("orders").select("o_orderkey", parse_filename(name).alias("p")).select("o_orderkey", "p.area", "p.block", "p.day", "p.redacted", F.array_join("p.notes", ";").alias("notes"))


@query("""SELECT o_orderkey, CASE o_custkey % 4 WHEN 3 THEN '' ELSE 'GC' END AS area, CASE o_custkey % 4 WHEN 0 THEN (o_custkey % 900)::VARCHAR WHEN 1 THEN (o_custkey % 900)::VARCHAR || ' B' WHEN 2 THEN 'A ' || o_custkey % 900 ELSE '' END AS block,
CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'Acme & Co' END AS operator, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderdate::DATE::VARCHAR END AS day, o_orderkey % 3 = 0 AS redacted, CASE o_orderkey % 4 WHEN 0 THEN '(2)' WHEN 1 THEN '_0' ELSE '' END AS variant,
concat_ws(';', CASE WHEN o_orderkey % 7 = 0 THEN 'no_date_token' END, CASE WHEN o_custkey % 4 = 3 THEN 'no_area_block_in_filename' END, CASE WHEN o_orderkey % 6 = 0 THEN 'no_operator_in_filename' END) AS notes
FROM (SELECT * REPLACE (o_orderdate + INTERVAL 3653 DAY AS o_orderdate) FROM orders)""")
def report_names(spark, t):
    """Names with a lease in four shapes, dates in three forms or none, with and without operator, redaction and variant."""
    from caseledger.functions.filenames import report_name

    lease, day, k = (F.col("o_custkey") % 900).cast("string"), F.date_add("o_orderdate", 3653), F.col("o_orderkey")
    m = F.col("o_custkey") % 4
    where = F.when(m == 0, F.concat(F.lit("gc"), lease)).when(m == 1, F.concat(F.lit("GC "), lease, F.lit(" b"))).when(m == 2, F.concat(F.lit("GC-A-"), lease)).otherwise(F.concat(F.lit("ZQ "), lease))
    who = F.when(k % 6 == 0, F.when(m == 3, "").otherwise("Report")).otherwise("Acme & Co")
    when = F.when(k % 7 == 0, "").when(k % 7 < 3, F.date_format(day, "d-MMM-yyyy")).when(k % 7 < 5, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "MMM_dd_yyyy"))
    name = F.concat(F.when(m == 3, "").otherwise(where), F.lit(" "), who, F.lit(" "), when, F.when(k % 3 == 0, " Redacted").otherwise(""), F.when(k % 4 == 0, " (2)").when(k % 4 == 1, "_0").otherwise(""), F.lit(".pdf"))
    p = report_name(name)
    return t("orders").select("o_orderkey", p.alias("p")).select("o_orderkey", "p.area", "p.block", "p.operator", "p.day", "p.redacted", "p.variant", F.array_join("p.notes", ";").alias("notes"))
