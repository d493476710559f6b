"""Synthetic registers, learning, files and streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from caseledger.functions.hashing import quantile_table
from caseledger.operators import scenario as S
from caseledger.operators.ordered import hash_rank
from caseledger.operators.synthesis import synthesize
from caseledger.queries.base import query, sql_hit, sql_mod, sql_pick

_K = S.Knobs()
_C = "foundry"


def _key(purpose: str, more: str = "") -> str:
    return f"'{_C}|' || c_custkey || '|{purpose}{more}|{S.SALT}'"


_PLAN_SQL = f"""WITH p AS (SELECT c_custkey, 'FO-' || upper(substr(sha256('{_C}|' || c_custkey || '|key'), 1, 10)) AS incident, DATE '2021-01-01' + {sql_mod(_key('day'), _K.days)}::INTEGER AS day,
 {sql_hit(_K.skip, _key('skip'))} AS skipped, {sql_pick(dict(_K.groups), _key('work_group'))} AS work_group, ({quantile_table(*_K.lag)})[{sql_mod(_key('report_lag'), 1024)} + 1]::INTEGER AS report_lag,
 CASE WHEN {sql_hit(_K.root, _key('root'))} THEN 3 ELSE 1 + {sql_mod(_key('chain'), 2)} END::INTEGER AS n_causes, (1 + ({sql_mod(_key('nrec'), 10)} < 2)::INTEGER)::INTEGER AS n_actions, {sql_hit(_K.scored, _key('hsblank'))} AS scored FROM customer)"""


def _plan(t):
    return S.plan(t("customer"), "c_custkey", _C, _K)


@query(_PLAN_SQL + " SELECT c_custkey, incident, day::VARCHAR AS day, skipped, work_group, report_lag, n_causes, n_actions, scored FROM p")
def scenario_plan(spark, t):
    return _plan(t).withColumn("day", F.col("day").cast("string")).drop("actions")


_AGREED = "CASE i WHEN 1 THEN 30 + " + sql_mod(_key("agreed", "|1"), 61) + " ELSE 30 + " + sql_mod(_key("agreed", "|2"), 61) + " END"
_DONE = f"({quantile_table(*_K.closeout)})[CASE i WHEN 1 THEN {sql_mod(_key('closeout', '|1'), 1024)} ELSE {sql_mod(_key('closeout', '|2'), 1024)} END + 1]"


@query(_PLAN_SQL + f""", x AS (SELECT incident, i, (day + report_lag + ({_AGREED})::INTEGER) AS agreed, (day + report_lag + ({_DONE})::INTEGER) AS completed FROM p, (SELECT unnest([1, 2]) AS i) WHERE i <= n_actions)
SELECT incident, i::INTEGER AS action, agreed::VARCHAR AS agreed, completed::VARCHAR AS completed, CASE WHEN completed > agreed THEN 'Behind' ELSE 'On Schedule' END AS status FROM x""")
def scenario_closeout(spark, t):
    return S.closeout(_plan(t)).withColumns({c: F.col(c).cast("string") for c in ("agreed", "completed")})


@query(_PLAN_SQL + """ SELECT incident, i::INTEGER AS number, CASE i WHEN 1 THEN 'Immediate' WHEN 3 THEN 'Root' ELSE 'Underlying' END AS type, ['worn seal', 'no permit'][(i - 1) % 2 + 1] AS text
FROM p, (SELECT unnest([1, 2, 3]) AS i) WHERE NOT skipped AND i <= n_causes""")
def scenario_causes(spark, t):
    """Donor texts are taken in turn."""
    return S.causes(_plan(t), ["worn seal", "no permit"])


@query()
def scenario_greedy_pairs(spark, t):
    """Eight planted recurrences among the first 150 reported incidents of the register, its stated size."""
    first = _plan(t).filter(~F.col("skipped")).orderBy("incident").limit(150)
    span = F.col("report_lag") + F.array_max(F.transform("actions", lambda a: a["done"]))
    found = [S.Candidate(r["incident"], r["day"], r["span"]) for r in first.select("incident", "day", span.alias("span")).collect()]
    pairs = S.plant_pairs(found, 8, 180, _C, (_K.start, _K.start + timedelta(days=_K.days - 1)))
    kind = "a string, b string, a_day date, b_day date, element string, work_group string"
    return spark.createDataFrame([(p.first, p.second, p.first_day, p.second_day, p.element, p.work_group) for p in pairs], kind)


@query()
def scenario_planted(spark, t):
    """Planted recurrences of every company: all customers in hash order, 150 a company, one pair for every 25 of them."""
    slices = hash_rank(t("customer").select("c_custkey"), "c_custkey").select("c_custkey", F.concat(F.lit("K"), F.floor((F.col("rank") - 1) / 150).cast("string")).alias("company"))
    span = F.col("report_lag") + F.array_max(F.transform("actions", lambda a: a["done"]))
    p = _plan(t).filter(~F.col("skipped")).join(slices, "c_custkey")
    c = p.select("company", F.col("incident").alias("ident"), "day", span.alias("span"), (F.col("c_custkey") % 40).alias("back"), (F.col("c_custkey") % 9).alias("ahead"))
    return S.plant_companies(c, 25, 180, (_K.start, _K.start + timedelta(days=_K.days - 1)))


_ROLES = {"investigation_lead": ("lead", "Investigator", "Investigation Lead"), "incident_classified_by": ("classified_by", "Classifier", "Incident Classifier"), "investigation_acceptor": ("acceptor", "Acceptor", "Investigation Acceptor"),
          "close_out_approval": ("close_out", "Approver", "Close-Out Approver"), "responsible_owner": ("owner", "Owner", "Responsible Owner")}
_OFFSETS = {"date_of_report": ("day", 5, 15), "approval_date": ("syn_date_of_report", 14, 45), "close_out_date": ("syn_approval_date", 30, 90), "action_due_date": ("syn_approval_date", 30, 180), "agreed_completion_date": ("syn_approval_date", 30, 180)}
_DATED = """SELECT *, try_cast(raw AS DATE) AS day FROM (SELECT o_orderkey, 'R' || o_orderkey AS id, CASE o_custkey % 50 WHEN 0 THEN ' ' WHEN 1 THEN '2024-13-01' ELSE strftime(o_orderdate + INTERVAL 10220 DAY, '%Y-%m-%d') END AS raw,
 list_sort(list_filter([CASE WHEN o_orderstatus = 'F' THEN 'Fire' END, CASE WHEN o_custkey % 3 = 0 THEN 'Pollution' END, CASE WHEN o_custkey % 5 = 0 THEN 'Fatality' END, CASE WHEN o_custkey % 11 = 0 THEN 'Crane' END], lambda x: x IS NOT NULL)) AS types,
 CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice * 2 END AS damage, 'GC ' || o_custkey % 900 AS site FROM orders)"""
for _name, (_base, _low, _high) in _OFFSETS.items():
    _DATED = f"SELECT *, ({_base} + ({_low} + {sql_mod(f'id || {chr(39)}{_name}{chr(39)}', _high - _low + 1)})::INTEGER)::DATE AS syn_{_name} FROM ({_DATED})"
_TIER = "CASE WHEN list_has_any(types, ['Fatality', 'Blowout', 'Explosion']) THEN 'Very Serious' WHEN list_has_any(types, ['Injury', 'LWC', 'Fire', 'Collision']) THEN 'Serious' WHEN len(types) > 0 THEN 'Incident' END"
_SYN = {f"{r}_name": f"'SYN-{label}-' || substr(sha256(id || '{salt}'), 1, 6)" for r, (salt, label, _) in _ROLES.items()} | {f"{r}_position": f"'Synthetic Role — {p}'" for r, (_, _, p) in _ROLES.items()} | {
    "action_status": "status", "schedule_status": f"CASE WHEN status = 'Completed' THEN 'N/A' WHEN {sql_mod("id || 'schedule_status'", 2)} = 0 THEN 'On Schedule' ELSE 'Behind' END",
    "incident_classification": "coalesce(tier, 'Unknown')", "worst_reasonable_outcome": "coalesce(tier, 'Unknown')", "involves_fatality_or_injury": "list_has_any(types, ['Fatality', 'Injury'])", "hs_risk_score": "score",
    "environment_reputation_classification": "CASE WHEN tier IS NULL THEN 'Unknown' WHEN list_contains(types, 'Pollution') THEN tier ELSE 'None' END",
    "environment_reputation_score": "CASE WHEN tier IS NULL THEN NULL WHEN list_contains(types, 'Pollution') THEN score ELSE 0 END",
    "financial_classification": "CASE WHEN damage IS NULL THEN 'Unknown' WHEN damage <= 25000 THEN 'Minor' WHEN damage <= 500000 THEN 'Moderate' ELSE 'Major' END",
    "financial_score": "CASE WHEN damage <= 25000 THEN 2 WHEN damage <= 500000 THEN 5 WHEN damage IS NOT NULL THEN 9 END",
    "unmitigated_risk_score": "score", "mitigated_risk_score": "CASE score WHEN 9 THEN 7 WHEN 5 THEN 3 WHEN 2 THEN 1 END",
    "incident_title": "CASE WHEN len(types) = 0 THEN 'Unspecified' ELSE array_to_string(types, ', ') END || ' incident at ' || site",
}


@query(f"""WITH d AS ({_DATED}), s AS (SELECT *, {_TIER} AS tier, CASE WHEN DATE '2026-08-09' - day > 730 THEN 'Completed' WHEN DATE '2026-08-09' - day > 183 THEN 'In Progress' ELSE 'Pending' END AS status FROM d),
v AS (SELECT *, CASE tier WHEN 'Very Serious' THEN 9 WHEN 'Serious' THEN 5 WHEN 'Incident' THEN 2 END AS score FROM s)
SELECT o_orderkey, {', '.join(f"CASE WHEN day IS NOT NULL THEN {x} END AS syn_{n}" for n, x in _SYN.items())}, {', '.join(f'syn_{n}::VARCHAR AS syn_{n}' for n in _OFFSETS)},
CASE WHEN day IS NOT NULL THEN concat_ws(',', CASE WHEN len(types) = 0 THEN 'unresolved_incident_classification' END, CASE WHEN damage IS NULL THEN 'unresolved_property_damage' END) END AS anomalies,
CASE WHEN trim(raw) = '' THEN 'no_incident_date' WHEN day IS NULL THEN 'unparseable_date' END AS skipped FROM v""")
def synthetic_columns(spark, t):
    """All synthetic columns of every order read as an incident; some have no date, a wrong one, no type or no damage."""
    part = F.col("o_custkey") % 50
    types = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "F", "Fire"), *[F.when(F.col("o_custkey") % n == 0, x) for n, x in ((3, "Pollution"), (5, "Fatality"), (11, "Crane"))]))
    o = t("orders").select(
        "o_orderkey", F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("id"), types.alias("types"), F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice") * 2).alias("damage"),
        F.concat(F.lit("GC "), (F.col("o_custkey") % 900).cast("string")).alias("site"),
        F.when(part == 0, " ").when(part == 1, "2024-13-01").otherwise(F.date_format(F.date_add("o_orderdate", 10220), "yyyy-MM-dd")).alias("raw"),
    )
    made = synthesize(o, "id", "raw", "types", "damage", "site").drop("id", "raw", "types", "damage", "site")
    return made.withColumns({"anomalies": F.array_join("anomalies", ",")} | {f"syn_{n}": F.col(f"syn_{n}").cast("string") for n in _OFFSETS})


@query()
def tfidf_topterms(spark, t):
    """Top terms by language of the mean of TF-IDF vectors (sublinear counts, L2 norm)."""
    from caseledger.operators.learning import top_terms

    return top_terms(t("documents").select("doc_id", "lang", "text"), "doc_id", "lang", 6)


@query()
def kmeans_agreement(spark, t):
    """Clusters of the embeddings against their labels: purity and adjusted Rand index."""
    from caseledger.operators.aggregates import contingency_scores
    from caseledger.operators.learning import kmeans

    return contingency_scores(kmeans(t("embeddings"), "embedding", k=6), "label", "cluster")


@query()
def classifier_scores(spark, t):
    """Logistic regression of a language from TF-IDF features, on the folds it was not fitted to."""
    from caseledger.operators.learning import cross_validated

    return cross_validated(t("documents").select("doc_id", "text", "lang"), "lang", folds=3)


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def csv_round_trip(spark, t):
    """Written as one folder of quoted CSV and read as strings again."""
    from caseledger.sources.files import read_csv, scratch, write_csv

    path = scratch(spark, "csv")
    write_csv(t("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", "o_orderstatus"), path, ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return read_csv(spark, path, ["o_orderkey", "o_orderpriority", "o_orderstatus"])


@query("SELECT doc_id::VARCHAR AS doc_id, coalesce(lang, '') AS lang, md5(coalesce(text, '')) AS text FROM documents")
def csv_embedded_newlines(spark, t):
    """Whole texts with line ends, commas and quotes, written as CSV and read back by ranges."""
    from caseledger.sources.files import scratch, write_csv
    from caseledger.sources.large_csv import read_large_csv

    path, columns = scratch(spark, "csv"), ["doc_id", "lang", "text"]
    write_csv(t("documents"), path, columns)
    return read_large_csv(spark, path, columns).select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("text"))


@query("SELECT event_id, user_id, event_type FROM events")
def json_round_trip(spark, t):
    from caseledger.sources.files import read_json, scratch, write_json

    path = scratch(spark, "json")
    write_json(t("events").select("event_id", "user_id", "event_type"), path)
    return read_json(spark, path, "event_id long, user_id long, event_type string")


@query("SELECT event_type, date_trunc('day', ts)::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL")
def stream_event_counts(spark, t):
    """Tumbling day counts with a watermark, run to the end over the available files."""
    from caseledger.streaming.counts import tumbling_counts

    e = t("events")
    out = tumbling_counts(spark, e, "ts", "event_type", "1 day", "2 days")
    return out.select("event_type", F.col("day").cast("date").cast("string").alias("day"), "n")
