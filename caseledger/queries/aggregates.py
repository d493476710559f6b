"""Counts, distributions, agreement, purity, sets and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.functions.dates import regime
from caseledger.functions.hashing import draw
from caseledger.operators.aggregates import agreement, consolidate, contingency_scores, disagreements, most_common, total_variation
from caseledger.operators.joins import near_values
from caseledger.queries.base import query, sql_mod


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def count_by_key(spark, t):
    return t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT * FROM (VALUES (0, 25000), (25000, 100000), (100000, 200000), (200000, 300000), (300000, 1000000000)) v(lo, hi))
SELECT lo::INTEGER AS lo, hi::INTEGER AS hi, count(o_orderkey) AS n FROM b LEFT JOIN orders ON o_totalprice >= lo AND o_totalprice < hi GROUP BY ALL""")
def histogram_half_open(spark, t):
    """Bins by CASE before the aggregate; empty bins come from the rule rows."""
    bins = [(0, 25000), (25000, 100000), (100000, 200000), (200000, 300000), (300000, 1000000000)]
    lo = F.when(F.lit(False), 0)
    for a, b in bins:
        lo = lo.when((F.col("o_totalprice") >= a) & (F.col("o_totalprice") < b), a)
    n = t("orders").groupBy(lo.alias("lo")).agg(F.count("*").alias("n"))
    return spark.createDataFrame(bins, "lo int, hi int").join(n, "lo", "left").select("lo", "hi", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("SELECT year::INTEGER AS year, CASE WHEN year <= 1993 THEN 'early' WHEN year <= 1996 THEN 'middle' ELSE 'late' END AS regime, count(*) AS n FROM (SELECT year(o_orderdate) AS year FROM orders) GROUP BY ALL")
def era_regime_split(spark, t):
    bands = (("early", 1900, 1993), ("middle", 1994, 1996), ("late", 1997, 2100))
    y = t("orders").select(F.year("o_orderdate").alias("year"))
    return y.groupBy("year", regime(F.col("year"), bands).alias("regime")).agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT o_orderpriority AS v, count(*) / sum(count(*)) OVER () AS p FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), q AS (SELECT o_orderpriority AS v, count(*) / sum(count(*)) OVER () AS q FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
SELECT round(0.5::DOUBLE * sum(abs(coalesce(p, 0) - coalesce(q, 0))), 6) AS tvd FROM p FULL JOIN q USING (v)""")
def tvd_real_vs_syn(spark, t):
    o = t("orders")
    return total_variation(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), "o_orderpriority")


@query("""WITH r AS (SELECT user_id, event_type AS mech, value > 50 AS hurt FROM events) SELECT mech, count(*) AS n, round(avg(hurt::INTEGER), 6) AS rate FROM r GROUP BY 1 HAVING count(*) >= 20""")
def conditional_rate(spark, t):
    return t("events").groupBy(F.col("event_type").alias("mech")).agg(F.count("*").alias("n"), F.round(F.avg((F.col("value") > 50).cast("int")), 6).alias("rate")).filter("n >= 20")


_RULE_SQL = """WITH j AS (SELECT doc_id, lang, quality, CASE WHEN n_chars < 200 THEN NULL WHEN n_chars > 800 THEN 1 ELSE 0 END AS rule FROM documents JOIN labels USING (doc_id))"""


@query(_RULE_SQL + " SELECT lang, count_if(rule = quality)::BIGINT AS agree, count_if(rule <> quality)::BIGINT AS disagree, count_if(rule IS NULL)::BIGINT AS abstain FROM j GROUP BY 1")
def agreement_matrix(spark, t):
    rule = F.when(F.col("n_chars") < 200, None).when(F.col("n_chars") > 800, 1).otherwise(0)
    j = t("documents").select("doc_id", "lang", "n_chars").join(t("labels").select("doc_id", "quality"), "doc_id").withColumn("rule", rule)
    return agreement(j, "lang", "quality", "rule")


_PASS_SQL = "SELECT o_orderkey AS k, i, CASE " + " ".join(f"WHEN {sql_mod('o_orderkey || ' + chr(39) + '|' + chr(39) + ' || i', 7)} = {n} THEN {v}" for n, v in ((0, "'abstain'"), (1, "NULL"), (2, "'b'"), (3, "'c'"))) + " ELSE 'a' END AS label FROM orders, (SELECT unnest([1, 2, 3]) AS i)"


_VOTE_SQL = """WITH p AS ({}), v AS (SELECT k, label, count(*) AS n, min(i) AS f FROM p WHERE label IS NOT NULL GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, f) AS r, bool_or(label = 'abstain') OVER (PARTITION BY k) AS ab FROM v)
SELECT k, label, n AS votes, CASE WHEN ab OR n <= 1 THEN 'low' WHEN n = 3 THEN 'high' ELSE 'medium' END AS confidence FROM w WHERE r = 1"""


@query(_VOTE_SQL.format(_PASS_SQL))
def consolidate_passes(spark, t):
    """Mode of three passes, first seen among equals; unparsed passes drop out of the vote but count in its size."""
    return _consolidated(t("orders"))


def _consolidated(orders):
    i = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("i")
    p = orders.select(F.col("o_orderkey").alias("k"), i)
    r = draw(7, F.col("k"), F.col("i"))
    p = p.withColumn("label", F.when(r == 0, "abstain").when(r == 1, None).when(r == 2, "b").when(r == 3, "c").otherwise("a"))
    return consolidate(p, "k", "i", "label", passes=3, abstain="abstain")


_ARI_SQL = """WITH d AS (SELECT label AS truth, (vec_id % 7) AS cluster FROM embeddings), c AS (SELECT truth, cluster, count(*) AS n FROM d GROUP BY ALL),
a AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS nij FROM c), r AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS ni FROM (SELECT sum(n) AS n FROM c GROUP BY truth)), s AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS nj FROM (SELECT sum(n) AS n FROM c GROUP BY cluster)),
t AS (SELECT sum(n)::DOUBLE AS n FROM c), m AS (SELECT sum(n)::DOUBLE AS top FROM (SELECT max(n) AS n FROM c GROUP BY cluster))
SELECT round(top / n, 6) AS purity, round((nij - ni * nj / (n * (n - 1) / 2)) / ((ni + nj) / 2 - ni * nj / (n * (n - 1) / 2)), 6) AS ari FROM a, r, s, t, m"""


@query(_ARI_SQL)
def purity_ari(spark, t):
    return contingency_scores(t("embeddings").select("label", (F.col("vec_id") % 7).alias("cluster")), "label", "cluster")


@query("""WITH w AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS atom FROM part), h AS (SELECT atom, count(*) AS n FROM w WHERE atom <> '' GROUP BY 1 HAVING count(*) >= 15)
SELECT h.atom, h.n, (SELECT count(DISTINCT p_partkey) FROM w JOIN h USING (atom)) AS reach FROM h""")
def atom_explode_head(spark, t):
    """Atoms with at least 15 occurrences, and how many rows have one."""
    w = t("part").select("p_partkey", F.explode(F.split(F.lower("p_name"), " ")).alias("atom")).filter("atom <> ''")
    h = w.groupBy("atom").agg(F.count("*").alias("n")).filter("n >= 15")
    reach = w.join(h, "atom", "left_semi").agg(F.count_distinct("p_partkey").alias("reach"))
    return h.crossJoin(F.broadcast(reach))


@query("""WITH k AS (SELECT CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN replace(p_type, ' ', '-') ELSE p_type END AS v FROM part), g AS (SELECT DISTINCT v, regexp_replace(lower(v), '[^a-z]', '', 'g') AS key FROM k)
SELECT key, count(*) AS spellings, string_agg(v, '|' ORDER BY v) AS members FROM g GROUP BY 1 HAVING count(*) > 1""")
def spelling_groups(spark, t):
    """Values that differ in case and marks alone; the types are written in three ways to have such groups."""
    p = t("part").withColumn("v", F.when(F.col("p_partkey") % 3 == 0, F.lower("p_type")).when(F.col("p_partkey") % 3 == 1, F.replace("p_type", F.lit(" "), F.lit("-"))).otherwise(F.col("p_type")))
    k = p.select("v", F.regexp_replace(F.lower("v"), "[^a-z]", "").alias("key")).distinct()
    return k.groupBy("key").agg(F.count("*").alias("spellings"), F.array_join(F.array_sort(F.collect_list("v")), "|").alias("members")).filter("spellings > 1")


_VOCAB_SQL = """WITH w AS (SELECT unnest(string_split(lower(p_name), ' ')) AS v FROM part UNION ALL SELECT lower(p_type) FROM part UNION ALL SELECT lower(p_brand) FROM part), c AS (SELECT v, count(*) AS n FROM w WHERE v <> '' GROUP BY 1),
t AS (SELECT v, n, list_distinct(string_split(v, ' ')) AS s FROM c)
SELECT a.v AS a, b.v AS b, least(a.n, b.n) AS n FROM t a JOIN t b ON a.v < b.v WHERE a.v || 's' = b.v OR contains(b.v, a.v) OR contains(a.v, b.v) OR len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) >= 0.5"""


@query(_VOCAB_SQL)
def near_duplicate_vocab(spark, t):
    """The vocabulary of three columns against itself: containment or half the words shared."""
    p = t("part")
    w = p.select(F.explode(F.split(F.lower("p_name"), " ")).alias("v")).unionAll(p.select(F.lower("p_type"))).unionAll(p.select(F.lower("p_brand")))
    return near_values(w.filter("v <> ''").groupBy("v").agg(F.count("*").alias("n")), "v", "n")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, min(event_id) LIMIT 3")
def most_common_top_k(spark, t):
    return most_common(t("events"), "event_type", "event_id", 3)


@query("SELECT name, value, n FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, first) AS r FROM (SELECT n_name AS name, floor(c_acctbal)::BIGINT % 5 AS value, count(*) AS n, min(c_custkey) AS first FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)) WHERE r <= 2")
def most_common_by_nation(spark, t):
    """The two most common values of every nation; of equally common ones the one that stands first."""
    d = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), (F.floor("c_acctbal") % 5).alias("value"), "c_custkey")
    return most_common(d, "value", "c_custkey", 2, by=["name"])


@query("SELECT c_nationkey AS k, 'customer' AS src, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, 'supplier', count(*) FROM supplier GROUP BY 1")
def bag_union(spark, t):
    a = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n")).withColumn("src", F.lit("customer"))
    b = t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n")).withColumn("src", F.lit("supplier"))
    return a.unionByName(b, allowMissingColumns=True).select("k", "src", "n")


@query("SELECT c_nationkey AS nationkey FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def set_difference(spark, t):
    a = t("customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey"))
    return a.subtract(t("supplier").filter("s_acctbal > 9000").select("s_nationkey"))


@query("SELECT n_nationkey AS nationkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey IN (SELECT s_nationkey FROM supplier)")
def set_intersection(spark, t):
    return t("nation").select(F.col("n_nationkey").alias("nationkey")).join(t("customer"), F.col("nationkey") == F.col("c_nationkey"), "left_semi").join(t("supplier"), F.col("nationkey") == F.col("s_nationkey"), "left_semi")


@query("""SELECT 'header_drift' AS kind, 0::BIGINT AS n UNION ALL SELECT 'non_ascii', count_if(regexp_matches(text, '[^\\x00-\\x7F]'))::BIGINT FROM documents UNION ALL SELECT 'blank', count_if(trim(text) = '')::BIGINT FROM documents
UNION ALL SELECT 'padded', count_if(trim(text) <> text)::BIGINT FROM documents UNION ALL SELECT 'bad_source', count_if(NOT regexp_full_match(source, 'src[0-9]+'))::BIGINT FROM documents""")
def quality_counts(spark, t):
    d = t("documents")
    want = {"doc_id", "text", "lang", "source", "n_chars"}
    one = d.agg(F.count_if(F.col("text").rlike(r"[^\x00-\x7F]")).alias("non_ascii"), F.count_if(F.trim("text") == "").alias("blank"), F.count_if(F.trim("text") != F.col("text")).alias("padded"), F.count_if(~F.col("source").rlike("^src[0-9]+$")).alias("bad_source"))
    one = one.withColumn("header_drift", F.lit(len(want.symmetric_difference(d.columns))).cast("long"))
    return one.unpivot([], ["header_drift", "non_ascii", "blank", "padded", "bad_source"], "kind", "n")


_TOP_SQL = "SELECT o_orderpriority, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3"


@query(_TOP_SQL)
def top_by_group(spark, t):
    w = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t("orders").withColumn("r", F.row_number().over(w)).filter("r <= 3").select("o_orderpriority", "o_orderstatus", "o_totalprice")


@query("""SELECT o_orderkey, rule, model, confidence, (CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END)::INTEGER AS place
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '15' WHEN 'O' THEN '3' ELSE '' END AS rule, CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '15' WHEN 2 THEN '3' ELSE '8' END AS model,
CASE left(o_orderpriority, 1) WHEN '1' THEN 'high' WHEN '2' THEN 'medium' WHEN '3' THEN 'low' ELSE '' END AS confidence FROM orders) WHERE rule <> '' AND model <> '' AND rule <> model""")
def disagreement_ranked(spark, t):
    """Rows that two labellers both label and label differently, the confident ones first."""
    d = t("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "15").when(F.col("o_orderstatus") == "O", "3").otherwise("").alias("rule"),
        F.element_at(F.array(*[F.lit(x) for x in ("", "15", "3", "8")]), (F.col("o_custkey") % 4 + 1).cast("int")).alias("model"),
        F.coalesce(F.get(F.array(F.lit("high"), F.lit("medium"), F.lit("low")), F.substring("o_orderpriority", 1, 1).cast("int") - 1), F.lit("")).alias("confidence"),
    )
    return disagreements(d, "rule", "model", "confidence")
