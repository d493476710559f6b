"""Numbering, runs, fills, slices and folds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.operators.ordered import anchor_slices, distribute_headers, forward_fill, forward_fill_in_parts, islands, linkage, ordinal, restart_runs, restart_runs_in_parts, values_at
from caseledger.queries.base import query


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ordinal FROM lineitem")
def ordinal_per_parent(spark, t):
    cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ordinal(t("lineitem").select("l_orderkey", *cols), ["l_orderkey"], cols)


@query("SELECT event_id, last_value(CASE WHEN event_id % 5 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM events")
def forward_fill_heading(spark, t):
    """Separator rows (every fifth) head the rows after them."""
    return forward_fill(t("events"), ["user_id"], ["ts", "event_id"], F.when(F.col("event_id") % 5 == 0, F.col("event_type")), "heading").select("event_id", "heading")


@query("""WITH d AS (SELECT DISTINCT l_suppkey, (l_partkey % 400) AS v FROM lineitem), k AS (SELECT *, v - row_number() OVER (PARTITION BY l_suppkey ORDER BY v) AS g FROM d)
SELECT l_suppkey, min(v) AS first, max(v) AS last, count(*) AS n FROM k GROUP BY l_suppkey, g""")
def integer_islands(spark, t):
    return islands(t("lineitem").select("l_suppkey", (F.col("l_partkey") % 400).alias("v")), ["l_suppkey"], "v")


@query("""WITH e AS (SELECT event_id, user_id, ts, event_id % 7 AS v, lag(event_id % 7) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT event_id, sum(CASE WHEN p IS NULL OR v <= p THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM e""")
def restart_split(spark, t):
    return restart_runs(t("events").withColumn("v", F.col("event_id") % 7), ["user_id"], ["ts", "event_id"], "v").select("event_id", "run")


@query("""WITH c AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS anchor FROM conversations)
SELECT conv_id, anchor, count(*) AS n_lines, md5(string_agg(text, ' ' ORDER BY turn)) AS content FROM c WHERE anchor > 0 GROUP BY ALL""")
def next_anchor_slice(spark, t):
    s = anchor_slices(t("conversations").select("conv_id", "turn", "role", "text"), ["conv_id"], "turn", F.col("role") == "user", "text")
    return s.select("conv_id", "anchor", "n_lines", F.md5(F.col("content").cast("binary")).alias("content"))


@query("""WITH v AS (SELECT user_id, list_sort(list(DISTINCT hour(ts) * 60 + minute(ts)))::DOUBLE[] AS xs FROM events GROUP BY 1),
f AS (SELECT user_id, list_reduce(list_transform(xs, lambda x: [{'v': x, 'f': x, 'r': 1}]), lambda acc, x: acc || [CASE WHEN x[1].v - acc[-1].v <= 15 AND x[1].v - acc[-1].f <= 20
  THEN {'v': x[1].v, 'f': acc[-1].f, 'r': acc[-1].r} ELSE {'v': x[1].v, 'f': x[1].v, 'r': acc[-1].r + 1} END]) AS rows FROM v)
SELECT user_id, u.r::INTEGER AS "row", min(u.v) AS first, max(u.v) AS last, count(*) AS n FROM (SELECT user_id, unnest(rows) AS u FROM f) GROUP BY ALL""")
def capped_linkage_rows(spark, t):
    """Single linkage with a gap of 15 and a span of 20 minutes; users are cut at their gaps, so a hot one is many parts."""
    v = t("events").select("user_id", (F.hour("ts") * 60 + F.minute("ts")).alias("x")).distinct()
    rows = linkage(v, "user_id", "x", 15, 20).groupBy("user_id", "first").agg(F.max("x").cast("double").alias("last"), F.count("*").alias("n"))
    return rows.withColumn("row", F.row_number().over(Window.partitionBy("user_id").orderBy("first")))


@query("""WITH s AS (SELECT o_orderpriority, list_sort(list(o_totalprice)) AS a FROM orders GROUP BY 1)
SELECT o_orderpriority, a[len(a) // 2 + 1] AS upper_median, a[floor(0.9 * (len(a) - 1))::INTEGER + 1] AS p90 FROM s""")
def floor_rank_percentiles(spark, t):
    """The upper median and the 0.9 floor rank of every group, by counting."""
    return values_at(t("orders"), "o_orderpriority", "o_totalprice", {"upper_median": lambda n: F.floor(n / 2), "p90": lambda n: F.floor(F.lit(0.9) * (n - 1))})


@query("""WITH l AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN '- ' || text WHEN 'system' THEN text || ':' ELSE text END AS s FROM conversations),
k AS (SELECT *, starts_with(s, '- ') AS bullet, NOT starts_with(s, '- ') AND suffix(s, ':') AS header FROM l WHERE s IS NOT NULL),
w AS (SELECT *, coalesce(lead(bullet) OVER o, FALSE) AS led, last_value(CASE WHEN NOT bullet THEN CASE WHEN header THEN s ELSE '' END END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, s ROWS UNBOUNDED PRECEDING) AS head FROM k WINDOW o AS (PARTITION BY conv_id ORDER BY turn, s)),
o AS (SELECT conv_id, turn, s, CASE WHEN bullet THEN CASE WHEN coalesce(head, '') <> '' THEN head || ' ' ELSE '' END || substr(s, 3) WHEN header AND led THEN NULL ELSE s END AS statement FROM w)
SELECT c.conv_id, coalesce(string_agg(statement, chr(10) ORDER BY turn, s), '') AS statements FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN o USING (conv_id) GROUP BY 1""")
def header_distribution(spark, t):
    """Statements built from a conversation's turns: system lines head, user lines are bullets."""
    line = F.when(F.col("role") == "user", F.concat(F.lit("- "), F.col("text"))).when(F.col("role") == "system", F.concat(F.col("text"), F.lit(":"))).otherwise(F.col("text"))
    lines = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("s")))).alias("a"))
    return lines.select("conv_id", F.array_join(distribute_headers(F.transform("a", lambda x: x["s"])), "\n").alias("statements"))


@query("""WITH l AS (SELECT doc_id, pos, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
g AS (SELECT *, sum(CASE WHEN pos = 1 OR regexp_matches(line, '^[A-Z][a-z]+ [a-z]+') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS seg FROM l)
SELECT doc_id, seg, md5(string_agg(line, ' ' ORDER BY pos)) AS statement FROM g GROUP BY ALL""")
def segment_statements(spark, t):
    """Hard-wrapped lines: a line that looks like a head opens a statement, any other joins the one before."""
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opens = (F.col("pos") == 0) | F.col("line").rlike("^[A-Z][a-z]+ [a-z]+")
    g = lines.withColumn("seg", F.sum(opens.cast("int")).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ")
    return g.groupBy("doc_id", "seg").agg(F.md5(joined.cast("binary")).alias("statement"))


@query("""WITH x AS (SELECT (user_id % 20)::BIGINT AS page, x, avg(CASE WHEN hour(ts) * 60 + minute(ts) <= x AND hour(ts) * 60 + minute(ts) + 60 >= x THEN 1.0 ELSE 0.0 END) AS crossed FROM events, (SELECT unnest(range(240, 1201, 40)) AS x) GROUP BY ALL),
k AS (SELECT *, x // 40 - row_number() OVER (PARTITION BY page ORDER BY x) AS g FROM x WHERE crossed <= 0.045), r AS (SELECT page, min(x)::BIGINT AS low, max(x)::BIGINT AS high, count(*) AS width FROM k GROUP BY page, g)
SELECT page, low, high, width FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY width DESC, low) AS rn FROM r) WHERE rn = 1""")
def page_gutters(spark, t):
    """The widest run of positions that few spans cross, by page: positions explode per span bucket, then islands."""
    e = t("events").select((F.col("user_id") % 20).alias("page"), (F.hour("ts") * 60 + F.minute("ts")).alias("a"))
    n = e.groupBy("page").agg(F.count("*").alias("n"))
    # Only the positions inside a span are exploded, not every position for every row.
    low = F.greatest(F.ceil(F.col("a") / 40) * 40, F.lit(240))
    high = F.least(F.floor((F.col("a") + 60) / 40) * 40, F.lit(1200))
    hits = e.withColumns({"low": low, "high": high}).filter("low <= high").select("page", F.explode(F.sequence("low", "high", F.lit(40).cast("long"))).alias("x")).groupBy("page", "x").agg(F.count("*").alias("c"))
    grid = n.select("page", "n", F.explode(F.sequence(F.lit(240).cast("long"), F.lit(1200).cast("long"), F.lit(40).cast("long"))).alias("x"))
    clear = grid.join(hits, ["page", "x"], "left").filter(F.coalesce("c", F.lit(0)) / F.col("n") <= 0.045)
    runs = islands(clear.select("page", (F.col("x") / 40).cast("long").alias("k")), ["page"], "k").select("page", (F.col("first") * 40).alias("low"), (F.col("last") * 40).alias("high"), F.col("n").alias("width"))
    return runs.withColumn("rn", F.row_number().over(Window.partitionBy("page").orderBy(F.desc("width"), "low"))).filter("rn = 1").drop("rn")


@query("SELECT event_id, last_value(CASE WHEN event_id % 50 = 0 THEN event_type END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM events")
def forward_fill_whole(spark, t):
    """Separator rows over the whole table as one group, which no task holds."""
    d = t("events").withColumn("all", F.lit(1))
    return forward_fill_in_parts(d, ["all"], ["ts", "event_id"], F.when(F.col("event_id") % 50 == 0, F.col("event_type")), "heading").select("event_id", "heading")


@query("""WITH e AS (SELECT event_id, ts, event_id % 7 AS v, lag(event_id % 7) OVER (ORDER BY ts, event_id) AS p FROM events)
SELECT event_id, sum(CASE WHEN p IS NULL OR v <= p THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM e""")
def restart_whole(spark, t):
    """Restarts counted over the whole table as one group."""
    d = t("events").select(F.lit(1).alias("all"), "ts", "event_id", (F.col("event_id") % 7).alias("v"))
    return restart_runs_in_parts(d, ["all"], ["ts", "event_id"], "v").select("event_id", "run")
