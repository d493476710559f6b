"""Process KPIs, recurrences and key joins. Orders stand for incidents, line items for actions and causes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from caseledger.functions.hashing import draw, quantile_table, rate_hit
from caseledger.operators.joins import exists_either, first_of, recurrences, suffix_collisions, two_tier_join
from caseledger.queries.base import query, sql_hit, sql_mod

_ACTION = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_ACTION_SQL = "'agreed|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"


def _actions(t):
    li = t("lineitem").select(*_ACTION, F.col("l_shipdate").cast("date").alias("completed"), "l_returnflag", "l_linestatus")
    o = t("orders").select("o_orderkey", "o_orderpriority", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    d = li.join(o, li.l_orderkey == o.o_orderkey)
    return d.withColumn("agreed", F.date_add("day", (F.lit(30) + draw(61, F.lit("agreed"), *[F.col(c) for c in _ACTION])).cast("int")))


_ACTIONS_SQL = f"""SELECT l.*, o.*, l.l_shipdate::DATE AS completed, o.o_orderdate::DATE AS day,
 o.o_orderdate::DATE + (30 + {sql_mod(_ACTION_SQL, 61)})::INTEGER AS agreed FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey"""


@query(f"WITH a AS ({_ACTIONS_SQL}) SELECT o_orderpriority, count(*) AS n, count_if(completed > agreed)::BIGINT AS overdue, round(count_if(completed > agreed) / count(*), 6) AS overdue_rate FROM a GROUP BY 1")
def kpi_overdue_rate(spark, t):
    late = F.count_if(F.col("completed") > F.col("agreed"))
    return _actions(t).groupBy("o_orderpriority").agg(F.count("*").alias("n"), late.alias("overdue"), F.round(late / F.count("*"), 6).alias("overdue_rate"))


@query(f"WITH a AS ({_ACTIONS_SQL}) SELECT o_orderpriority, median(date_diff('day', day, completed))::DOUBLE AS median_lag FROM a GROUP BY 1")
def kpi_median_lag(spark, t):
    return _actions(t).groupBy("o_orderpriority").agg(F.median(F.datediff("completed", "day")).cast("double").alias("median_lag"))


_REPORT_SQL = sql_mod("'report|' || o_orderkey", 11)


@query(f"WITH a AS ({_ACTIONS_SQL}) SELECT o_orderpriority, median(date_diff('day', day + (5 + {_REPORT_SQL})::INTEGER, completed))::DOUBLE AS median_closeout FROM a GROUP BY 1")
def kpi_median_closeout(spark, t):
    a = _actions(t).withColumn("report", F.date_add("day", (F.lit(5) + draw(11, F.lit("report"), F.col("o_orderkey"))).cast("int")))
    return a.groupBy("o_orderpriority").agg(F.median(F.datediff("completed", "report")).cast("double").alias("median_closeout"))


_LEADER_SQL = f"SELECT *, CASE WHEN {sql_hit(0.3, chr(39) + 'leader|' + chr(39) + ' || o_orderkey')} THEN '' ELSE 'SYN-' || o_custkey END AS leader FROM orders"


def _incidents(t):
    return t("orders").withColumn("leader", F.when(rate_hit(0.3, F.lit("leader"), F.col("o_orderkey")), "").otherwise(F.concat(F.lit("SYN-"), F.col("o_custkey"))))


def _causes(t):
    return t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus", "l_suppkey")


@query(f"""WITH i AS ({_LEADER_SQL}) SELECT o_orderpriority, count(*) AS n,
 count_if(leader = '' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey))::BIGINT AS skipped,
 round(count_if(leader = '' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)) / count(*), 6) AS skip_rate FROM i GROUP BY 1""")
def kpi_skip_rate(spark, t):
    """Blank leader and no cause: an anti join, over all incidents."""
    i = _incidents(t)
    skipped = i.filter("leader = ''").join(_causes(t), "o_orderkey", "left_anti").groupBy("o_orderpriority").agg(F.count("*").alias("skipped"))
    n = i.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    got = F.coalesce("skipped", F.lit(0).cast("long"))
    return n.join(skipped, "o_orderpriority", "left").select("o_orderpriority", "n", got.alias("skipped"), F.round(got / F.col("n"), 6).alias("skip_rate"))


@query(f"""WITH i AS ({_LEADER_SQL}) SELECT o_orderpriority, count(*) AS investigated,
 round(count_if(o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 5 = 0)) / count(*), 6) AS root_depth FROM i WHERE leader <> '' GROUP BY 1""")
def kpi_root_depth(spark, t):
    """Share of investigated incidents with a root cause: a semi join."""
    i = _incidents(t).filter("leader <> ''")
    deep = i.join(_causes(t).filter("l_suppkey % 5 = 0"), "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("d"))
    n = i.groupBy("o_orderpriority").agg(F.count("*").alias("investigated"))
    return n.join(deep, "o_orderpriority", "left").select("o_orderpriority", "investigated", F.round(F.coalesce("d", F.lit(0)) / F.col("investigated"), 6).alias("root_depth"))


_TAGS = ("elimination", "engineering", "admin", "ppe")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_SCORE_SQL = f"""WITH a AS ({_ACTIONS_SQL}), i AS ({_LEADER_SQL}),
g AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ra AS (SELECT g.r_name, count(*) AS recs, count_if(completed > agreed) AS late, median(date_diff('day', day, completed)) AS med,
  count_if(l_partkey % 4 IN (2, 3)) AS soft, count_if(l_suppkey % 7 <> 0) AS owned FROM a JOIN g ON o_custkey = c_custkey GROUP BY 1),
ri AS (SELECT g.r_name, count(*) AS incidents, count_if(leader <> '') AS inv, count_if(o_orderkey % 3 <> 0) AS scored,
  count_if(leader = '' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS skipped,
  count_if(leader <> '' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 5 = 0)) AS deep FROM i JOIN g ON o_custkey = c_custkey GROUP BY 1),
k AS (SELECT r_name, unnest(['incidents', 'overdue_rate', 'median_closeout_days', 'skip_rate', 'root_cause_depth', 'admin_ppe_share', 'owner_completeness', 'score_completeness']) AS kpi,
  unnest([incidents::DOUBLE, late / recs, med::DOUBLE, skipped / incidents, deep / inv, soft / recs, owned / recs, scored / incidents]) AS v FROM ra JOIN ri USING (r_name))
SELECT kpi, """ + ", ".join(f"round(max(v) FILTER (WHERE r_name = '{r}'), 6) AS {r.lower().replace(' ', '_')}" for r in _REGIONS) + " FROM k GROUP BY kpi"


@query(_SCORE_SQL)
def kpi_scoreboard(spark, t):
    """KPI by company matrix: one partial aggregate over actions, one over incidents, then a pivot of 40 values."""
    g = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    late = F.count_if(F.col("completed") > F.col("agreed"))
    ra = _actions(t).join(g, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name").agg(
        F.count("*").alias("recs"), late.alias("late"), F.median(F.datediff("completed", "day")).alias("med"), F.count_if(F.col("l_partkey") % 4 >= 2).alias("soft"), F.count_if(F.col("l_suppkey") % 7 != 0).alias("owned"))
    c = _causes(t).groupBy("o_orderkey").agg(F.max(F.col("l_suppkey") % 5 == 0).alias("root"))
    i = _incidents(t).join(c, "o_orderkey", "left").join(g, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name").agg(
        F.count("*").alias("incidents"), F.count_if(F.col("leader") != "").alias("inv"), F.count_if(F.col("o_orderkey") % 3 != 0).alias("scored"),
        F.count_if((F.col("leader") == "") & F.col("root").isNull()).alias("skipped"), F.count_if((F.col("leader") != "") & F.coalesce("root", F.lit(False))).alias("deep"))
    pairs = {"incidents": F.col("incidents"), "overdue_rate": F.col("late") / F.col("recs"), "median_closeout_days": F.col("med"), "skip_rate": F.col("skipped") / F.col("incidents"), "root_cause_depth": F.col("deep") / F.col("inv"),
             "admin_ppe_share": F.col("soft") / F.col("recs"), "owner_completeness": F.col("owned") / F.col("recs"), "score_completeness": F.col("scored") / F.col("incidents")}
    k = ra.join(i, "r_name").select("r_name", F.explode(F.array(*[F.struct(F.lit(n).alias("kpi"), v.cast("double").alias("v")) for n, v in pairs.items()])).alias("x")).select("r_name", "x.*")
    return k.groupBy("kpi").pivot("r_name", list(_REGIONS)).agg(F.round(F.max("v"), 6)).withColumnsRenamed({r: r.lower().replace(" ", "_") for r in _REGIONS})


def _events(t):
    return t("events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type").withColumns({
        "closed": F.date_add("day", (F.col("event_id") % 2).cast("int")), "elements": F.array(F.col("event_id") % 3, F.lit(3) + F.col("event_id") % 4)})


_REC_SQL = """WITH e AS (SELECT event_id, user_id, ts::DATE AS d, ts::DATE + (event_id % 2)::INTEGER AS c, event_id % 3 AS x, 3 + event_id % 4 AS y FROM events),
p AS (SELECT a.event_id AS a, b.event_id AS b, a.user_id, date_diff('day', a.d, b.d) AS gap FROM e a JOIN e b ON a.user_id = b.user_id AND b.d > a.c
 AND date_diff('day', a.d, b.d) BETWEEN 0 AND 7 AND (b.d > a.d OR b.event_id > a.event_id) AND (a.x = b.x OR a.y = b.y))"""


@query(_REC_SQL + " SELECT a, b, user_id, gap::INTEGER AS gap FROM p")
def recurrence_pairs(spark, t):
    return recurrences(_events(t), "event_id", "user_id", "day", "closed", "elements", 7)


@query(_REC_SQL + " SELECT gap::INTEGER AS gap, count(*) AS n FROM p GROUP BY 1")
def recurrence_count(spark, t):
    return recurrences(_events(t), "event_id", "user_id", "day", "closed", "elements", 7).groupBy("gap").agg(F.count("*").alias("n"))


_SPINE_SQL = """WITH o AS (SELECT o_orderkey, DATE '2024-01-01' + (o_orderkey % 30)::INTEGER AS day, ((o_orderkey * 37) % 1440)::INTEGER AS minute, o_custkey % 500 AS user_id FROM orders),
e AS (SELECT *, ts::DATE AS day, (hour(ts) * 60 + minute(ts))::INTEGER AS minute FROM events),
t1 AS (SELECT day, minute, arg_min(event_type, event_id) AS v FROM e GROUP BY ALL), t2 AS (SELECT day, user_id, arg_min(event_type, event_id) AS v FROM e GROUP BY ALL)"""


def _spine(t):
    o = t("orders").select("o_orderkey", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int")).alias("day"), ((F.col("o_orderkey") * 37) % 1440).cast("int").alias("minute"), (F.col("o_custkey") % 500).alias("user_id"))
    e = t("events").select("event_id", "event_type", "user_id", F.col("ts").cast("date").alias("day"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"))
    return o, e


@query(_SPINE_SQL + """ SELECT o_orderkey, CASE WHEN t1.v IS NOT NULL THEN 1 WHEN t2.v IS NOT NULL THEN 2 ELSE 0 END AS tier, coalesce(t1.v, t2.v) AS event_type
 FROM o LEFT JOIN t1 USING (day, minute) LEFT JOIN t2 ON o.day = t2.day AND o.user_id = t2.user_id""")
def spine_two_tier_join(spark, t):
    o, e = _spine(t)
    return two_tier_join(o, e, [("day", "minute"), ("day", "user_id")], "event_id", ["event_type"]).select("o_orderkey", F.coalesce("tier", F.lit(0)).alias("tier"), "event_type")


@query(_SPINE_SQL + """ SELECT o_orderkey, (t1.v IS NOT NULL OR t2.v IS NOT NULL) AS joined FROM o LEFT JOIN t1 USING (day, minute) LEFT JOIN t2 ON o.day = t2.day AND o.user_id = t2.user_id""")
def key_union_semi(spark, t):
    o, e = _spine(t)
    return exists_either(o, e, [("day", "minute"), ("day", "user_id")]).select("o_orderkey", "joined")


@query("""WITH m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1)
SELECT o_orderkey, coalesce(l_partkey, -1) AS l_partkey, coalesce(l_suppkey, -1) AS l_suppkey FROM orders LEFT JOIN m ON o_orderkey = l_orderkey""")
def manifest_last_wins(spark, t):
    m = first_of(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), ["l_orderkey"], F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), last=True)
    return t("orders").select("o_orderkey").join(m, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", *[F.coalesce(c, F.lit(-1).cast("long")).alias(c) for c in ("l_partkey", "l_suppkey")])


@query("SELECT text_key, min(doc_id) AS doc_id, count(*) AS links FROM (SELECT *, md5(text) AS text_key FROM documents) GROUP BY 1")
def dedup_first_wins(spark, t):
    return t("documents").select(F.md5(F.col("text").cast("binary")).alias("text_key"), "doc_id").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("links"))


@query("""WITH k AS (SELECT doc_id, lang || '-' || source || '-' || (n_chars // 500) AS key, text FROM documents)
SELECT doc_id, CASE WHEN count(*) OVER (PARTITION BY key) > 1 THEN key || '-' || substr(sha256(text), 1, 8) ELSE key END AS key FROM k""")
def collision_suffix(spark, t):
    """Every member of a colliding key gets a content hash."""
    k = t("documents").select("doc_id", F.concat_ws("-", "lang", "source", F.floor(F.col("n_chars") / 500).cast("string")).alias("key"), F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 8).alias("h"))
    return suffix_collisions(k, "key", "h", "doc_id").select("doc_id", "key")


@query(f"""WITH d AS (SELECT o_orderkey, {sql_mod("'decide|' || o_orderkey", 1024)} AS r FROM orders)
SELECT n, count(*) AS plans FROM (SELECT (r % 3 + 1)::INTEGER AS n FROM d) GROUP BY 1""")
def chain_lengths(spark, t):
    return t("orders").select((draw(1024, F.lit("decide"), F.col("o_orderkey")) % 3 + 1).cast("int").alias("n")).groupBy("n").agg(F.count("*").alias("plans"))


_TABLE = quantile_table(45, 0.6)


@query(f"""WITH s AS (SELECT o_orderpriority, 30 + o_custkey % 61 AS span, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT span, avg(CASE WHEN v > span THEN 1.0 ELSE 0.0 END) AS rate FROM (SELECT DISTINCT span FROM s), (SELECT unnest({_TABLE}) AS v) GROUP BY 1)
SELECT o_orderpriority, sum(n)::BIGINT AS n, round(sum(n * rate) / sum(n), 6)::DOUBLE AS overdue_rate FROM s JOIN r USING (span) GROUP BY 1""")
def analytic_overdue(spark, t):
    """What share of each priority's orders the rules expect to be late: lateness against its own agreed spans, averaged over
    the whole quantile table. Spans are counted first, so 61 of them at most meet the 1,024 rule rows."""
    spans = t("orders").groupBy("o_orderpriority", (30 + F.col("o_custkey") % 61).alias("span")).agg(F.count("*").alias("n"))
    late = F.size(F.filter(F.lit(np.array(_TABLE, dtype=np.int32)), lambda v: v > F.col("span"))) / len(_TABLE)
    rates = spans.select("span").distinct().withColumn("rate", late)
    return spans.join(F.broadcast(rates), "span").groupBy("o_orderpriority").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("rate")) / F.sum("n"), 6).alias("overdue_rate"))
