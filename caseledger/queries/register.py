"""Register building: filters with side counts, joins with defaults and checks, form text, layout, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions import forms as R
from caseledger.functions.hashing import rate_hit
from caseledger.operators import layout as L
from caseledger.operators.joins import recurrences
from caseledger.operators.provenance import base_tokens, fill_gaps
from caseledger.operators.synthesis import severity
from caseledger.queries.base import query, sql_hit


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'ok' WHEN o_orderstatus = 'P' THEN 'parse_failed' ELSE 'no_text_layer' END AS status, (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') AS kept, count(*) AS n FROM orders GROUP BY ALL")
def status_filter_counts(spark, t):
    """What is kept, and why the rest is not."""
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "parse_failed").otherwise("no_text_layer")
    return t("orders").groupBy(status.alias("status"), ((status == "ok") & (F.col("o_orderpriority") != "5-LOW")).alias("kept")).agg(F.count("*").alias("n"))


@query(f"SELECT c_custkey, CASE WHEN {sql_hit(0.4, chr(39) + 'gate|' + chr(39) + ' || c_custkey')} THEN 'made' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN {sql_hit(0.4, chr(39) + 'gate|' + chr(39) + ' || c_custkey')} THEN '' ELSE c_name END AS c_name FROM customer")
def policy_gated_fill(spark, t):
    """Both columns have gaps; only the one whose policy says ``fabricate`` is filled."""
    policy = {"c_mktsegment": "fabricate", "c_name": "leave_blank"}
    gap = rate_hit(0.4, F.lit("gate"), F.col("c_custkey"))
    d = base_tokens(t("customer").select("c_custkey", *[F.when(gap, "").otherwise(F.col(c)).alias(c) for c in policy]), list(policy))
    for c, p in policy.items():
        d = fill_gaps(d, c, F.lit("made"), "syn") if p == "fabricate" else d
    return d.select("c_custkey", *policy)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) SELECT doc_id, count(*) AS n, sum(length(trim(regexp_replace(replace(x, 'the ', ''), '\\s+', ' ', 'g'))))::BIGINT AS chars
FROM l WHERE NOT regexp_matches(x, '^[A-Z]{4}') AND trim(regexp_replace(replace(x, 'the ', ''), '\\s+', ' ', 'g')) <> '' GROUP BY 1""")
def furniture_lines(spark, t):
    kept = R.keep_lines(F.split("text", "\n"), ["^[A-Z]{4}"], "the ")
    d = t("documents").select("doc_id", kept.alias("k")).filter(F.size("k") > 0)
    return d.select("doc_id", F.size("k").cast("long").alias("n"), F.aggregate("k", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))


@query("SELECT count_if(len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda w: w <> '')) >= 5)::BIGINT AS usable, count(*) AS n FROM documents")
def usable_text(spark, t):
    return t("documents").agg(F.count_if(F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != "")) >= 5).alias("usable"), F.count("*").alias("n"))


@query("SELECT c_custkey, coalesce(len(m), 0)::INTEGER AS marks FROM customer LEFT JOIN (SELECT o_custkey, list_distinct(list(o_orderpriority)) AS m FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey")
def marks_default(spark, t):
    """A left join whose missing side is an empty list."""
    m = t("orders").filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("m"))
    d = t("customer").select("c_custkey").join(m, F.col("c_custkey") == F.col("o_custkey"), "left")
    return d.select("c_custkey", F.size(F.coalesce("m", F.array().cast("array<string>"))).alias("marks"))


@query("SELECT l.doc_id, coalesce(d.lang, '') AS lang, coalesce(b.n, 0)::BIGINT AS size, '' AS gold FROM (SELECT doc_id + 3 AS doc_id FROM labels) l LEFT JOIN documents d USING (doc_id) LEFT JOIN (SELECT doc_id, n_chars AS n FROM documents WHERE n_chars > 500) b USING (doc_id)")
def sample_scaffold(spark, t):
    """A worksheet of sampled keys; keys without a row get blank cells."""
    k = t("labels").select((F.col("doc_id") + 3).alias("doc_id"))
    d = t("documents")
    out = k.join(d.select("doc_id", "lang"), "doc_id", "left").join(d.filter("n_chars > 500").select("doc_id", F.col("n_chars").alias("n")), "doc_id", "left")
    return out.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("n", F.lit(0).cast("long")).alias("size"), F.lit("").alias("gold"))


@query("SELECT doc_id, coalesce(CASE WHEN n_chars > 2000 THEN 'long' END, CASE quality WHEN 1 THEN 'good' END, '') AS category, CASE WHEN n_chars > 2000 THEN 'rule' WHEN quality = 1 THEN 'model' ELSE '' END AS source FROM documents LEFT JOIN labels USING (doc_id)")
def label_precedence(spark, t):
    """The rule's label first, the model's unless it abstained."""
    d = t("documents").select("doc_id", "n_chars").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    rule, model = F.when(F.col("n_chars") > 2000, "long"), F.when(F.col("quality") == 1, "good")
    return d.select("doc_id", F.coalesce(rule, model, F.lit("")).alias("category"), F.when(rule.isNotNull(), "rule").when(model.isNotNull(), "model").otherwise("").alias("source"))


@query("SELECT n_name AS name, n_nationkey AS nationkey FROM nation")
def unique_inverse(spark, t):
    """An inverse map that raises on a repeated key."""
    n = t("nation").groupBy(F.col("n_name").alias("name")).agg(F.count("*").alias("c"), F.min("n_nationkey").alias("nationkey"))
    return n.select("name", F.when(F.col("c") == 1, F.col("nationkey")).otherwise(F.raise_error(F.concat(F.lit("repeated key "), F.col("name")))).alias("nationkey"))


@query("SELECT c_custkey, r_name AS tag FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def registry_lookup(spark, t):
    """An exact lookup whose miss is an error, never a null."""
    tags = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("tag"))
    d = t("customer").select("c_custkey", "c_nationkey").join(F.broadcast(tags), "c_nationkey", "left")
    return d.select("c_custkey", F.coalesce("tag", F.raise_error(F.lit("unknown key"))).alias("tag"))


@query("SELECT doc_id, CASE WHEN strpos(text, ' the ') = 0 THEN md5(text) ELSE md5(trim(CASE WHEN strpos(r, '.') = 0 THEN r ELSE substr(r, 1, strpos(r, '.') - 1) END)) END AS section FROM (SELECT *, substr(text, strpos(text, ' the ') + 5) AS r FROM documents)")
def subhead_sections(spark, t):
    return t("documents").select("doc_id", F.md5(R.section(F.col("text"), " the ", ["."]).cast("binary")).alias("section"))


@query("SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'parse_failed' WHEN turn % 5 = 3 THEN 'absent_legitimate' WHEN turn % 5 = 2 THEN 'typed' WHEN regexp_matches(text, '^[A-Z][A-Za-z ]{0,58}:') THEN 'typed' ELSE 'freetext' END AS class FROM conversations")
def classify_fields(spark, t):
    m = F.col("turn") % 5
    text = F.when(m == 4, None).when(m == 3, "N/A").when(m == 2, F.concat(F.lit("Human Error: "), F.col("text"))).otherwise(F.col("text"))
    return t("conversations").select("conv_id", "turn", R.field_class(text, ["n/a", "none"]).alias("class"))


@query("SELECT doc_id, sha256('Label: [' || substr(text, 1, 1200) || ']') AS prompt FROM documents")
def build_prompts(spark, t):
    return t("documents").select("doc_id", F.sha2(R.prompt("Label: [{text}]", F.col("text")).cast("binary"), 256).alias("prompt"))


_WORDS = ["supervision", "communication", "weather", "unsure", "SUPERVISION"]


@query(f"""WITH a AS (SELECT o_orderkey, {_WORDS}[o_custkey % 5 + 1] AS word, o_orderkey % 24 - 1 AS element, o_orderkey % 7 AS form FROM orders)
SELECT o_orderkey, CASE WHEN form = 5 THEN '' WHEN word = 'unsure' THEN 'unsure' WHEN word IN ('supervision', 'communication') AND form NOT IN (3, 4) AND element BETWEEN 1 AND 20 THEN word ELSE '' END AS category,
(CASE WHEN form NOT IN (3, 4, 5) AND word IN ('supervision', 'communication') AND element BETWEEN 1 AND 20 THEN element ELSE 0 END)::INTEGER AS element FROM a""")
def parse_responses(spark, t):
    """Recorded answers, read strictly: out-of-range, boolean, quoted and unknown ones are discarded, and so is what has no braces."""
    word, element, form = F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (F.col("o_custkey") % 5 + 1).cast("int")), (F.col("o_orderkey") % 24 - 1).cast("string"), F.col("o_orderkey") % 7
    value = F.when(form == 3, "true").when(form == 4, F.concat(F.lit('"'), element, F.lit('"'))).otherwise(element)
    body = F.concat(F.lit('{"category": "'), word, F.lit('", "element": '), value, F.lit("}"))
    raw = F.when(form == 5, F.concat(word, F.lit(" "), element)).when(form == 6, F.concat(F.lit("Sure:\n"), body, F.lit("\nI hope so."))).otherwise(body)
    d = t("orders").select("o_orderkey", R.response(raw, ["supervision", "communication"], "unsure").alias("r"))
    return d.select("o_orderkey", F.coalesce("r.category", F.lit("")).alias("category"), F.coalesce("r.element", F.lit(0)).alias("element"))


_TYPES = ("Blowout", "Fire", "Collision", "Muster", "Other")


@query(f"""WITH o AS (SELECT *, [({list(_TYPES)})[o_orderkey % 5 + 1], ({list(_TYPES)})[o_custkey % 5 + 1]] AS types FROM orders),
t AS (SELECT *, CASE WHEN list_contains(types, 'Blowout') THEN 'Very Serious' WHEN list_has_any(types, ['Fire', 'Collision']) THEN 'Serious' ELSE 'Incident' END AS tier FROM o)
SELECT o_orderkey, tier, CASE WHEN o_totalprice <= 25000 THEN 'Minor' WHEN o_totalprice <= 500000 THEN 'Moderate' ELSE 'Major' END AS financial, (CASE tier WHEN 'Very Serious' THEN 7 WHEN 'Serious' THEN 3 ELSE 1 END)::INTEGER AS mitigated FROM t""")
def severity_fields(spark, t):
    names = F.array(*[F.lit(x) for x in _TYPES])
    types = F.array(*[F.element_at(names, (F.col(c) % 5 + 1).cast("int")) for c in ("o_orderkey", "o_custkey")])
    s = severity(types, F.col("o_totalprice"))
    return t("orders").select("o_orderkey", s["incident_classification"].alias("tier"), s["financial_classification"].alias("financial"), s["mitigated_risk_score"].alias("mitigated"))


@query("SELECT event_id, 'late' AS type, event_type AS detail FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'odd', event_type FROM events WHERE event_id % 2 = 1")
def anomaly_stream(spark, t):
    """Reported, never repaired: a flat side output of per-record anomaly lists."""
    kinds = F.filter(F.array(F.when(F.col("event_id") % 3 == 0, "late"), F.when(F.col("event_id") % 2 == 1, "odd")), lambda x: x.isNotNull())
    return t("events").select("event_id", F.explode(kinds).alias("type"), F.col("event_type").alias("detail"))


@query("SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS split FROM documents")
def splits_by_regime(spark, t):
    """The split of every document."""
    return t("documents").select("doc_id", F.when(F.col("n_chars") < 500, "short").otherwise("long").alias("split"))


@query("SELECT l_orderkey, count(*) AS n, md5(string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ';' ORDER BY l_linenumber, l_partkey, l_suppkey)) AS causes FROM lineitem GROUP BY 1")
def donor_views(spark, t):
    """Donor rows by identifier, in order of their number."""
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    text = F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"), x["l_suppkey"].cast("string"))), ";")
    return t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.md5(text.cast("binary")).alias("causes"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'skip' WHEN page_id % 3 = 1 THEN 'mismatch' ELSE 'fetch' END AS action, sha256(html) AS sha FROM pages")
def fetch_plan(spark, t):
    """What a download would do: skip on an equal hash, complain on another one, fetch without any."""
    sha = F.sha2(F.col("html").cast("binary"), 256)
    known = F.when(F.col("page_id") % 3 == 0, sha).when(F.col("page_id") % 3 == 1, "0" * 64)
    return t("pages").select("page_id", F.when(known.isNull(), "fetch").when(known == sha, "skip").otherwise("mismatch").alias("action"), sha.alias("sha"))


@query("""WITH e AS (SELECT event_id, user_id, ts::DATE AS d, event_id % 3 AS x FROM events), p AS (SELECT a.event_id AS a, b.event_id AS b FROM e a JOIN e b ON a.user_id = b.user_id AND b.d > a.d AND date_diff('day', a.d, b.d) <= 3 AND a.x = b.x)
SELECT a, b FROM p WHERE NOT (a % 2 = 0 AND b % 2 = 0)""")
def coincidence_pairs(spark, t):
    """Detected pairs less the planted ones."""
    e = t("events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), F.array(F.col("event_id") % 3).alias("elements")).withColumn("closed", F.col("day"))
    found = recurrences(e, "event_id", "user_id", "day", "closed", "elements", 3).select("a", "b")
    return found.exceptAll(found.filter("a % 2 = 0 AND b % 2 = 0"))


@query("""WITH RECURSIVE s AS (SELECT user_id, (event_id % 4)::INTEGER AS priority, hour(ts)::INTEGER AS start, (hour(ts) + 3)::INTEGER AS "end", event_type AS what FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY priority, start, "end", what) AS k FROM s),
r AS (SELECT user_id, 0::BIGINT AS k, []::STRUCT(a INTEGER, z INTEGER)[] AS kept, FALSE AS took FROM (SELECT DISTINCT user_id FROM s)
 UNION ALL SELECT o.user_id, o.k, CASE WHEN f.hit THEN r.kept ELSE list_append(r.kept, {'a': o.start, 'z': o."end"}) END, NOT f.hit
 FROM r JOIN o ON o.user_id = r.user_id AND o.k = r.k + 1, LATERAL (SELECT len(list_filter(r.kept, lambda y: y.a < o."end" AND o.start < y.z)) > 0 AS hit) f)
SELECT user_id, priority, start, "end", what FROM r JOIN o USING (user_id, k) WHERE took""")
def disjoint_matches(spark, t):
    """The kept matches of every user, in order of priority."""
    s = t("events").select("user_id", (F.col("event_id") % 4).alias("priority"), F.hour("ts").alias("start"), (F.hour("ts") + 3).alias("end"), F.col("event_type").alias("what"))
    return L.disjoint_matches(s, "user_id")


@query("SELECT page, md5(string_agg(event_type, ' ' ORDER BY band, col, top, event_type)) AS text FROM (SELECT user_id AS page, event_type, (hour(ts) // 6)::BIGINT AS band, (event_id % 2)::BIGINT AS col, event_id AS top FROM events) GROUP BY 1")
def reading_order(spark, t):
    d = t("events").select(F.col("user_id").alias("page"), F.floor(F.hour("ts") / 6).alias("band"), (F.col("event_id") % 2).alias("column"), F.col("event_id").alias("top"), F.col("event_type").alias("text"))
    return L.reading_order(d, "page").select("page", F.md5(F.col("text").cast("binary")).alias("text"))


@query("""WITH e AS (SELECT user_id AS page, event_id, hour(ts) AS y, minute(ts) AS x, event_type FROM events), m AS (SELECT page, event_id AS mark, x, y FROM e WHERE event_id % 5 = 0), w AS (SELECT page, event_type AS text, x AS x0, x + 5 AS x1, y FROM e WHERE event_id % 5 <> 0),
n AS (SELECT m.page, mark, m.x, text, x0, x1, lag(x1) OVER (PARTITION BY m.page, mark ORDER BY x0, x1, text) AS before FROM m JOIN w ON w.page = m.page AND abs(w.y - m.y) <= 4 AND x0 >= m.x),
f AS (SELECT *, bool_and(CASE WHEN before IS NULL THEN x0 - x <= 40 ELSE x0 - before <= 12 END) OVER (PARTITION BY page, mark ORDER BY x0, x1, text ROWS UNBOUNDED PRECEDING) AS near FROM n)
SELECT page, mark, coalesce(string_agg(text, ' ' ORDER BY x0, x1, text) FILTER (near), '') AS label FROM f GROUP BY 1, 2""")
def proximity_labels(spark, t):
    """Marks and words of pages built from all events."""
    e = t("events").select((F.col("user_id")).alias("page"), "event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"), "event_type")
    marks = e.filter("event_id % 5 = 0").select("page", F.col("event_id").alias("mark"), F.col("m").cast("double").alias("x"), F.col("h").cast("double").alias("y"))
    words = e.filter("event_id % 5 <> 0").select("page", F.col("event_type").alias("text"), F.col("m").cast("double").alias("x0"), (F.col("m") + 5).cast("double").alias("x1"), F.col("h").cast("double").alias("y"))
    return L.labels_of_marks(marks, words, "page")


@query("""WITH RECURSIVE e AS (SELECT user_id AS page, hour(ts)::BIGINT AS h, 200 + 4.5 * minute(ts) AS x0, event_id % 3 = 0 AS anchor FROM events),
rows_ AS (SELECT page, h, row_number() OVER (PARTITION BY page ORDER BY h) - 1 AS k, list({'x0': x0, 'x1': x0 + 40}) AS spans, bool_or(anchor) AS anchor FROM e GROUP BY page, h),
g AS (SELECT page, k, x::INTEGER AS x, anchor, len(list_filter(spans, lambda s: s.x0 < x AND x < s.x1)) > 0 AS c, len(list_filter(spans, lambda s: s.x1 <= x)) > 0 AS l, len(list_filter(spans, lambda s: s.x0 >= x)) > 0 AS r FROM rows_, (SELECT unnest(range(240, 371)) AS x)),
n AS (SELECT page, count(*) AS n FROM rows_ GROUP BY 1), g2 AS (SELECT * FROM g UNION ALL SELECT page, n, x, FALSE, TRUE, FALSE, FALSE FROM n, (SELECT unnest(range(240, 371))::INTEGER AS x)),
w AS (SELECT page, x, -1::BIGINT AS k, -1::BIGINT AS first, 0 AS bad, -1::BIGINT AS good, -1::BIGINT AS done, -1::BIGINT AS last FROM n, (SELECT unnest(range(240, 371))::INTEGER AS x)
 UNION ALL SELECT g2.page, g2.x, g2.k, CASE WHEN w.first >= 0 AND NOT f.ends THEN w.first WHEN NOT g2.c THEN g2.k ELSE -1 END, CASE WHEN w.first >= 0 AND NOT f.ends THEN f.bad ELSE 0 END, CASE WHEN NOT g2.c THEN g2.k ELSE w.good END, CASE WHEN f.ends THEN w.first ELSE -1 END, w.good
 FROM w JOIN g2 ON g2.page = w.page AND g2.x = w.x AND g2.k = w.k + 1 JOIN n ON n.page = w.page, LATERAL (SELECT w.bad + g2.c::INTEGER AS bad, w.first >= 0 AND (g2.k = n.n OR g2.c AND (w.bad + 1) > 0.15 * (g2.k - w.first + 1)) AS ends) f),
b AS (SELECT w.page, w.x, w.done AS first, w.last FROM w JOIN g ON g.page = w.page AND g.x = w.x AND g.k BETWEEN w.done AND w.last WHERE w.done >= 0 AND w.last - w.done >= 2 GROUP BY w.page, w.x, w.done, w.last HAVING count_if(g.anchor) >= 2 AND bool_or(g.l) AND bool_or(g.r)),
best AS (SELECT r.page, r.k, r.h, arg_min(b.x, (first - last) * 1000 + b.x) AS x FROM rows_ r JOIN b ON b.page = r.page AND r.k BETWEEN first AND last GROUP BY 1, 2, 3),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY page, x ORDER BY k) AS run FROM best)
SELECT page, x AS gutter, min(h) AS first, max(h) AS last FROM runs GROUP BY page, x, run HAVING count(*) >= 3""")
def covering_bands(spark, t):
    """Two-column bands of pages built from all events, a page a user, a row an hour."""
    e = t("events").select(F.col("user_id").alias("page"), F.hour("ts").cast("long").alias("row"), (F.lit(200) + F.lit(4.5) * F.minute("ts")).alias("x0"), (F.col("event_id") % 3 == 0).alias("anchor"))
    rows = e.groupBy("page", "row").agg(F.collect_list(F.struct("x0", (F.col("x0") + 40).alias("x1"))).alias("spans"), F.bool_or("anchor").alias("anchor"))
    return L.covering_bands(rows, "page")


@query()
def silhouette(spark, t):
    """Silhouette of the k-means clusters of the embeddings."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    from caseledger.operators.learning import kmeans

    d = kmeans(t("embeddings"), "embedding", 6).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    score = ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(d)
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")
