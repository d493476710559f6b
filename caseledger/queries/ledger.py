"""Provenance, coverage, validity, draws and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions.hashing import draw, mint_key, pseudonym, quantile_table, rate_hit, table_draw, weighted_pick
from caseledger.operators.joins import column_difference
from caseledger.operators.ordered import hash_rank, top_n, water_fill_sample
from caseledger.operators.provenance import base_tokens, coverage, domain_guard, fill_gaps, first_failure, orphans, real_only, token_tally, validity
from caseledger.queries.base import query, sql_hit, sql_mod, sql_pick

_COLS = ("o_orderpriority", "o_orderstatus")
_WEIGHTS = {"Immediate": 5, "Underlying": 3, "Root": 2}
_KEY = "'fill|' || o_orderkey"


def _filled(t):
    d = t("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.when(rate_hit(0.3, F.lit("blank"), F.col("o_orderkey")), "").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"), "o_orderstatus", F.col("o_orderkey").alias("_k"))
    d = base_tokens(d, ("o_orderkey", *_COLS), keys=("o_orderkey",))
    d = fill_gaps(d, "o_orderpriority", F.when(F.col("o_orderstatus") == "P", "from-status"), "xw")
    return fill_gaps(d, "o_orderpriority", weighted_pick(_WEIGHTS, F.lit("fill"), F.col("_k")), "syn")


_FILLED_SQL = f"""WITH b AS (SELECT o_orderkey AS k, CASE WHEN {sql_hit(0.3, "'blank|' || o_orderkey")} THEN '' ELSE o_orderpriority END AS p, o_orderstatus, {sql_pick(_WEIGHTS, _KEY)} AS syn FROM orders),
f AS (SELECT k, o_orderstatus, CASE WHEN p <> '' THEN p WHEN o_orderstatus = 'P' THEN 'from-status' ELSE syn END AS o_orderpriority, CASE WHEN p <> '' THEN 'src' WHEN o_orderstatus = 'P' THEN 'xw' ELSE 'syn' END AS token FROM b)"""


@query(_FILLED_SQL + " SELECT k::VARCHAR AS o_orderkey, o_orderpriority, token FROM f")
def gapfill_coalesce_prov(spark, t):
    return _filled(t).select("o_orderkey", "o_orderpriority", F.col("o_orderpriority__prov").alias("token"))


@query(_FILLED_SQL + " SELECT k::VARCHAR AS o_orderkey, CASE WHEN token = 'syn' THEN '' ELSE o_orderpriority END AS o_orderpriority, CASE WHEN token = 'syn' THEN '' ELSE token END AS token FROM f")
def real_only_blanking(spark, t):
    return real_only(_filled(t), _COLS).select("o_orderkey", "o_orderpriority", F.col("o_orderpriority__prov").alias("token"))


@query(_FILLED_SQL + """ SELECT 'o_orderkey' AS "column", 0::BIGINT AS "real", 0::BIGINT AS pseud, count(*) AS fabricated, 0::BIGINT AS unfilled FROM f
UNION ALL SELECT 'o_orderpriority', count_if(token IN ('src', 'xw'))::BIGINT, 0, count_if(token = 'syn')::BIGINT, 0 FROM f UNION ALL SELECT 'o_orderstatus', count(*), 0, 0, 0 FROM f""")
def provenance_tally(spark, t):
    return token_tally(_filled(t), ("o_orderkey", *_COLS))


@query("SELECT '' AS o_orderkey, '' AS \"column\" WHERE false")
def provenance_orphans(spark, t):
    """No row: every blank cell has a blank token and every other a known one."""
    return orphans(_filled(t), ("o_orderkey", *_COLS), "o_orderkey")


@query(_FILLED_SQL + """, m AS (SELECT 'o_orderpriority' AS "column", count_if(token IN ('src', 'xw'))::BIGINT AS "real", count_if(token = 'syn')::BIGINT AS fabricated, count(*) AS total FROM f)
SELECT "column", "real", fabricated, total, round("real" / total, 6) AS real_share FROM m""")
def disposition_rollup(spark, t):
    """Measured shares of one column's cells, from its token grid."""
    d = token_tally(_filled(t), ("o_orderpriority",)).withColumn("total", F.col("real") + F.col("pseud") + F.col("fabricated") + F.col("unfilled"))
    return d.select("column", "real", "fabricated", "total", F.round(F.coalesce(F.try_divide("real", "total"), F.lit(0.0)), 6).alias("real_share"))


@query(f"""WITH d AS (SELECT CASE WHEN {sql_hit(0.2, "'cov|' || c_custkey")} THEN ' ' ELSE c_name END AS c_name, c_mktsegment, c_nationkey::VARCHAR AS c_nationkey FROM customer)
SELECT 'c_name' AS "column", count_if(trim(c_name) <> '')::BIGINT AS filled, count(*) AS total FROM d UNION ALL SELECT 'c_mktsegment', count_if(trim(c_mktsegment) <> '')::BIGINT, count(*) FROM d UNION ALL SELECT 'c_nationkey', count(c_nationkey), count(*) FROM d""")
def coverage_by_column(spark, t):
    d = t("customer").select(F.when(rate_hit(0.2, F.lit("cov"), F.col("c_custkey")), " ").otherwise(F.col("c_name")).alias("c_name"), "c_mktsegment", "c_nationkey")
    return coverage(d)


@query("""WITH c AS (SELECT 'p_name' AS "column", CASE WHEN trim(p_name) = '' THEN NULL WHEN contains(upper(p_name), 'RED') THEN 'form_label' WHEN len(string_split(trim(p_name), ' ')) < 2 THEN 'too_short' ELSE 'passed' END AS reason FROM part
UNION ALL SELECT 'p_type', CASE WHEN NOT regexp_full_match(p_type, '[A-Z]+( [A-Z]+)*') THEN 'bad_pattern' WHEN right(trim(p_type), 1) NOT IN ('L', 'S') THEN 'truncated' ELSE 'passed' END FROM part)
SELECT "column", reason, count(*) AS n FROM c WHERE reason IS NOT NULL GROUP BY ALL""")
def validity_first_fail(spark, t):
    return validity(t("part"), {"p_name": first_failure(F.col("p_name"), label_tokens=("RED",), min_words=2), "p_type": first_failure(F.col("p_type"), pattern="[A-Z]+( [A-Z]+)*", terminal=("L", "S"))})


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE '' END AS o_orderpriority, o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AS guarded FROM orders")
def domain_guard_orders(spark, t):
    d = domain_guard(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ("1-URGENT", "2-HIGH"))
    return d.select("o_orderkey", "o_orderpriority", F.col("o_orderpriority__guarded").alias("guarded"))


@query("SELECT * FROM (VALUES ('c_phone', 'missing'), ('c_acctbal', 'orphan')) v(\"column\", side)")
def reconcile_columns(spark, t):
    return column_difference(["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_phone"], t("customer"))


@query(f"SELECT {sql_mod('c_custkey::VARCHAR', 1826)} % 100 AS bucket, count(*) AS n FROM customer GROUP BY 1")
def hash_mod_buckets(spark, t):
    return t("customer").select((draw(1826, F.col("c_custkey")) % 100).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


_GROUPS = {"red": 17, "amber": 41, "green": 9, "blue": 33}


@query(f"SELECT c_custkey, {sql_pick(_GROUPS, chr(39) + 'wg' + chr(39) + ' || c_custkey', by_key=True)} AS work_group FROM customer")
def weighted_pick_sorted(spark, t):
    """Keys walked in sorted order, parts joined without a mark."""
    return t("customer").select("c_custkey", weighted_pick(_GROUPS, F.lit("wg"), F.col("c_custkey"), by_key=True, sep="").alias("work_group"))


@query(f"SELECT c_custkey, {sql_pick(_GROUPS, chr(39) + 'harbour|' + chr(39) + ' || c_custkey || ' + chr(39) + '|work_group|salt' + chr(39))} AS work_group FROM customer")
def weighted_pick_listed(spark, t):
    """Keys walked as listed, parts joined by a pipe and salted."""
    return t("customer").select("c_custkey", weighted_pick(_GROUPS, F.lit("harbour"), F.col("c_custkey"), F.lit("work_group"), F.lit("salt")).alias("work_group"))


@query(f"SELECT o_orderpriority, count_if({sql_hit(0.125, chr(39) + 'hit|' + chr(39) + ' || o_orderkey')})::BIGINT AS hits, count(*) AS n FROM orders GROUP BY 1")
def rate_hit_share(spark, t):
    return t("orders").groupBy("o_orderpriority").agg(F.count_if(rate_hit(0.125, F.lit("hit"), F.col("o_orderkey"))).alias("hits"), F.count("*").alias("n"))


_T = quantile_table(21, 0.6)


@query(f"SELECT o_orderkey, ({_T})[{sql_mod(chr(39) + 'lag|' + chr(39) + ' || o_orderkey', 1024)} + 1]::INTEGER AS days FROM orders")
def quantile_draw(spark, t):
    return t("orders").select("o_orderkey", table_draw(_T, F.lit("lag"), F.col("o_orderkey")).alias("days"))


@query("SELECT c_custkey, 'OP-' || substr(sha256('pepper|' || upper(c_name)), 1, 6) AS pseudonym FROM customer")
def pseudonyms(spark, t):
    return t("customer").select("c_custkey", pseudonym(F.col("c_name"), "OP-", "pepper").alias("pseudonym"))


@query("SELECT o_orderkey, 'INC-' || upper(substr(sha256('harbour|' || o_orderkey || '|key'), 1, 10)) AS key FROM orders")
def mint_keys(spark, t):
    return t("orders").select("o_orderkey", mint_key("INC-", F.lit("harbour"), F.col("o_orderkey"), F.lit("key")).alias("key"))


@query("""SELECT c_custkey, rank::BIGINT AS rank, ['harbour', 'quarry', 'foundry'][slice + 1] AS company FROM
 (SELECT *, ((rank - 1) // 50)::INTEGER AS slice FROM (SELECT c_custkey, row_number() OVER (ORDER BY sha256(c_custkey::VARCHAR), c_custkey) AS rank FROM customer)) WHERE slice < 3""")
def hash_rank_slices(spark, t):
    r = hash_rank(t("customer").select("c_custkey"), "c_custkey").withColumn("slice", F.floor((F.col("rank") - 1) / 50).cast("int")).filter("slice < 3")
    return r.select("c_custkey", "rank", F.element_at(F.array(*[F.lit(x) for x in ("harbour", "quarry", "foundry")]), F.col("slice") + 1).alias("company"))


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r FROM documents) WHERE r <= 30")
def topn_per_group(spark, t):
    return top_n(t("documents").select("lang", "doc_id"), ["lang"], [F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id")], 30)


@query("""WITH RECURSIVE g AS (SELECT lang, count(*) AS size, count(*) OVER () AS k FROM documents WHERE lang IS NOT NULL GROUP BY 1), a AS (SELECT lang, size, least(greatest(1, 120 // k), size) AS got FROM g),
w AS (SELECT 0 AS step, list({'lang': lang, 'size': size, 'got': got} ORDER BY lang) AS x FROM a
 UNION ALL SELECT step + 1, list_transform(x, lambda y: {'lang': y.lang, 'size': y.size, 'got': y.got + (y.size > y.got AND len(list_filter(x, lambda z: z.size > z.got AND (z.size - z.got > y.size - y.got OR z.size - z.got = y.size - y.got AND z.lang < y.lang))) < 120 - list_sum(list_transform(x, lambda z: z.got)))::BIGINT})
 FROM w WHERE list_sum(list_transform(x, lambda y: y.got)) < 120 AND len(list_filter(x, lambda y: y.size > y.got)) > 0),
f AS (SELECT unnest(arg_max(x, step)) AS y FROM w), d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r FROM documents)
SELECT doc_id, d.lang FROM d JOIN f ON d.lang = f.y.lang WHERE r <= f.y.got""")
def waterfill_sample(spark, t):
    """Water-filled allocation of 120 rows over languages, in hash order."""
    return water_fill_sample(t("documents").select("doc_id", "lang"), "lang", "doc_id", 120)


@query("""WITH j AS (SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r FROM j), a AS (SELECT * FROM f WHERE r <= 10),
rest AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r2 FROM j WHERE doc_id NOT IN (SELECT doc_id FROM a))
SELECT doc_id, lang, quality, 'floor' AS pass FROM a UNION ALL SELECT doc_id, lang, quality, 'spread' FROM rest WHERE r2 <= 5""")
def stratified_sample(spark, t):
    """Ten rows a category by hash, then five a language from the rows not yet taken."""
    j = t("documents").select("doc_id", "lang").join(t("labels").select("doc_id", "quality"), "doc_id")
    order = [F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id")]
    a = top_n(j, ["quality"], order, 10)
    b = top_n(j.join(a.select("doc_id"), "doc_id", "left_anti"), ["lang"], order, 5)
    return a.withColumn("pass", F.lit("floor")).unionByName(b.withColumn("pass", F.lit("spread")))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY sha256(o_orderkey::VARCHAR), o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F') WHERE r <= 60")
def pilot_subset(spark, t):
    """The first 60 finished rows in hash order: a top-k, not a sort."""
    return t("orders").filter("o_orderstatus = 'F'").select("o_orderkey").orderBy(F.sha2(F.col("o_orderkey").cast("string"), 256), "o_orderkey").limit(60)
