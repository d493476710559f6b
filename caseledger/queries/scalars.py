"""Scalar rules over whole tables: sentences, first matches, tails, glyphs, fragments, years, keys, typed and safe cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions import forms as R
from caseledger.functions import text as X
from caseledger.functions.dates import year_of
from caseledger.queries.base import query
from caseledger.sources.files import first_existing, read_csv, scratch, typed, write_csv


@query(r"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents),
h AS (SELECT doc_id, list_filter(s, lambda x: regexp_matches(x, '(the|der|les|los) '))[-1] AS last FROM s)
SELECT doc_id, md5(CASE WHEN length(last) BETWEEN 25 AND 400 THEN last END) AS sentence FROM h""")
def last_sentences(spark, t):
    """The last sentence with an article, if it has a sensible length."""
    return t("documents").select("doc_id", F.md5(X.last_sentence_with(F.col("text"), "(the|der|les|los) ").cast("binary")).alias("sentence"))


@query(r"SELECT doc_id, coalesce(nullif(regexp_extract(substr(text, 1, 400), '[A-Z][a-z]+ing', 0), ''), nullif(regexp_extract(text, '[a-z]+tion', 0), ''), nullif(regexp_extract(source, '\d+', 0), '')) AS found FROM documents")
def first_matches(spark, t):
    """The first place that has what is looked for: the opening, the whole text, the source."""
    d = t("documents").select("doc_id", "text", "source", F.substring("text", 1, 400).alias("opening"))
    return d.select("doc_id", F.coalesce(X.first_match("[A-Z][a-z]+ing", F.col("opening")), X.first_match("[a-z]+tion", F.col("text")), X.first_match(r"\d+", F.col("source"))).alias("found"))


@query("SELECT doc_id, md5(CASE WHEN strpos(text, 'and the') > 0 THEN substr(text, strpos(text, 'and the')) ELSE '' END) AS tail FROM documents")
def sequence_tails(spark, t):
    """From a heading to the end, blank without it."""
    return t("documents").select("doc_id", F.md5(R.tail_from(F.col("text"), "and the").cast("binary")).alias("tail"))


_GLYPHS = "text || CASE doc_id % 3 WHEN 0 THEN '(cid:' || CAST(doc_id AS VARCHAR(9)) || ') end' WHEN 1 THEN '(cid:x)' ELSE '' END"


@query(rf"SELECT doc_id, md5(regexp_replace({_GLYPHS}, '\(cid:\d+\)', '•', 'g')) AS text FROM documents")
def stripped_glyphs(spark, t):
    return t("documents").select("doc_id", F.md5(X.strip_glyphs(F.expr(_GLYPHS)).cast("binary")).alias("text"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE p_type END = upper(p_type) AND CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE p_type END IN ('ECONOMY', 'small', 'STANDARD') AS fragment FROM part")
def label_fragments(spark, t):
    """Capitals alone make no fragment, and neither does the list alone."""
    c = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.col("p_type"))
    return t("part").select("p_partkey", X.is_label_fragment(F.concat(F.lit(" "), c, F.lit(" ")), ["ECONOMY", "small", "STANDARD"]).alias("fragment"))


_YEARS = "CASE o_orderkey % 4 WHEN 0 THEN 'on ' ELSE '' END || CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))"


@query("SELECT CASE WHEN o_orderkey % 4 <> 0 THEN year(o_orderdate) END::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1")
def incident_years(spark, t):
    """Years of dates at the start of a text; a text that begins otherwise has none."""
    return t("orders").groupBy(year_of(F.expr(_YEARS)).alias("year")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN NULL ELSE concat_ws('-', CASE WHEN o_custkey % 3 <> 0 THEN 'GC' END, o_custkey, strftime(o_orderdate, '%Y%m%d'), CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END) END AS number FROM orders")
def incident_numbers(spark, t):
    """Area, block, date and time that are there, three of them at least."""
    parts = F.when(F.col("o_custkey") % 3 != 0, "GC").otherwise(" "), F.col("o_custkey"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus"))
    return t("orders").select("o_orderkey", X.joined_key(*parts).alias("number"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END::INTEGER AS whole, o_orderdate::DATE::VARCHAR AS day, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'a b' ELSE o_orderpriority END AS text FROM orders")
def typed_cells(spark, t):
    """Strings as strictly typed cells: blanks are null, control characters one space."""
    k = F.col("o_orderkey")
    whole = F.when(k % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    text = F.when(k % 3 == 0, "").when(k % 3 == 1, "a\x00\x07b").otherwise(F.col("o_orderpriority"))
    return t("orders").select("o_orderkey", typed(whole, "int").alias("whole"), typed(F.date_format("o_orderdate", "yyyy-MM-dd"), "date").cast("string").alias("day"), typed(text, "text").alias("text"))


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def layered_scan(spark, t):
    """The first of several places that has the table; a missing one is an empty table."""
    base = scratch(spark, "layers")
    write_csv(t("nation"), f"{base}/verbatim", ["n_nationkey", "n_name"])
    found = read_csv(spark, first_existing(spark, [f"{base}/enriched", f"{base}/verbatim"]), ["n_nationkey", "n_name"])
    return found.unionByName(read_csv(spark, f"{base}/absent", ["n_nationkey", "n_name"], missing_ok=True))


@query("SELECT o_orderpriority, printf('%.1f%%', round_even(100.0 * count_if(o_orderstatus = 'F') / count(*), 1)) AS share FROM orders GROUP BY 1")
def percent_texts(spark, t):
    share = X.percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*"))
    return t("orders").groupBy("o_orderpriority").agg(share.alias("share"))
