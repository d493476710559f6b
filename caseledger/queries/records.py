"""Loading, headers, labels, twins, sorted outputs, exports, identities and clustering sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.functions import atoms as A
from caseledger.functions import text as X
from caseledger.functions.prose import shift_prose_dates
from caseledger.operators import records as R
from caseledger.operators.ordered import numbered_sort
from caseledger.queries.base import query, sql_mod
from caseledger.sources.files import discard, scratch, write_csv


@query("SELECT 'nation' AS name, n_nationkey::VARCHAR AS id, n_name AS text FROM nation UNION ALL SELECT 'region', r_regionkey::VARCHAR, r_name FROM region")
def register_tables(spark, t):
    """Two tables written as CSV and loaded as a register, each by its own header."""
    folder = scratch(spark, "register")
    for name in ("nation", "region"):
        d = t(name)
        write_csv(d.select(*[F.col(c).cast("string").alias(c) for c in d.columns]), f"{folder}/{name}.csv", d.columns)
    got = R.load_register(spark, folder, ["nation", "region"])
    return got["nation"].select(F.lit("nation").alias("name"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("text")).unionAll(got["region"].select(F.lit("region"), "r_regionkey", "r_name"))


@query("SELECT split_part(p_type, ' ', 1) AS tag, count(*) AS n, md5(string_agg(p_partkey || '=' || p_name, ';' ORDER BY p_partkey)) AS digest FROM part GROUP BY 1")
def templates_by_tag(spark, t):
    rows = t("part").select(F.split("p_type", " ")[0].alias("tag"), F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    tags = [r[0] for r in rows.select("tag").distinct().limit(64).collect()]  # the rule file's own domain
    got = R.templates_by_tag(rows, tags)
    text = F.array_join(F.transform("templates", lambda x: F.concat_ws("=", x["id"].cast("string"), x["text"])), ";")
    return got.select("tag", F.size("templates").cast("long").alias("n"), F.md5(text.cast("binary")).alias("digest"))


@query("SELECT o_orderkey, o_orderstatus AS status, o_orderstatus || ' ' || o_orderpriority AS record FROM orders")
def numbered_fields(spark, t):
    """A field by its number, and the text of all numbered fields: look-alike columns do not count."""
    d = t("orders").select("o_orderkey", F.col("o_orderstatus").alias("src_f07_status"), F.col("o_orderpriority").alias("src_f18_cause"), F.lit("no").alias("src_form_revision"), F.lit("no").alias("src_f7_odd"))
    return d.select("o_orderkey", F.col(R.numbered(d.columns, 7)).alias("status"), R.whole_record(d.columns).alias("record"))


@query("SELECT c_custkey AS src_c_custkey, c_mktsegment AS segment FROM customer")
def prefixed_columns(spark, t):
    return R.prefixed(t("customer").select("c_custkey", "c_mktsegment"), {"c_mktsegment": "segment"})


@query("SELECT page_id::VARCHAR AS page, trim(regexp_replace(url, '\\s+', ' ', 'g')) AS link FROM pages")
def sidecar_columns(spark, t):
    return R.sidecar(t("pages").withColumn("url", F.concat(F.lit("  "), F.col("url"), F.lit(" \n"))), {"page_id": "page", "url": "link"})


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def label_group_columns(spark, t):
    """A table's columns out of label groups: keys first, labels that two groups share once."""
    groups = [("state", ["o_orderstatus", "o_totalprice"]), ("money", ["o_totalprice"]), ("rest", ["o_orderdate"])]
    return t("orders").select(*R.label_columns(groups, ["o_orderkey"], ["state", "money"]))


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 'src' ELSE 'xw' END AS o_orderstatus_token, CASE WHEN o_custkey % 2 = 0 THEN 'src' ELSE 'syn' END AS o_orderpriority_token FROM orders")
def positional_twins(spark, t):
    """Values and provenance of the same position, dealt differently."""
    cols = ["o_orderstatus", "o_orderpriority"]
    tokens = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "src").otherwise("xw").alias("o_orderstatus"), F.when(F.col("o_custkey") % 2 == 0, "src").otherwise("syn").alias("o_orderpriority"))
    return R.with_twin(t("orders").select("o_orderkey", *cols), tokens, "o_orderkey", cols)


@query("SELECT o_orderpriority, o_custkey, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) - 1 AS place FROM orders")
def stable_order(spark, t):
    """Every order's place in sorted outputs: ranges sort themselves, and no task holds them all."""
    return numbered_sort(t("orders").select("o_orderpriority", "o_custkey", "o_orderkey"), "o_orderpriority")


@query("""WITH c AS (SELECT c_mktsegment AS name, count_if(c_acctbal < 0) AS part, count(*) AS whole FROM customer GROUP BY 1)
SELECT name, round(part / whole, 6) AS ratio, name IN ('BUILDING', 'FURNITURE') AS target FROM c""")
def ratio_order(spark, t):
    c = t("customer").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count_if(F.col("c_acctbal") < 0).alias("part"), F.count("*").alias("whole"))
    return R.by_ratio(c, "part", "whole", ["BUILDING", "FURNITURE"], "name").select("name", "ratio", "target")


@query("""WITH s AS (SELECT CASE o_custkey % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'two' ELSE 'three' END AS company, o_orderpriority AS kpi, count(*) AS value FROM orders GROUP BY ALL)
SELECT kpi, max(value) FILTER (WHERE company = 'one') AS one, max(value) FILTER (WHERE company = 'two') AS two, max(value) FILTER (WHERE company = 'three') AS three FROM s GROUP BY 1""")
def company_comparison(spark, t):
    company = F.element_at(F.array(F.lit("one"), F.lit("two"), F.lit("three")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("company")
    scores = t("orders").groupBy(company, F.col("o_orderpriority").alias("kpi")).agg(F.count("*").alias("value"))
    return R.comparison(scores, ["one", "two", "three"])


_PLANTS = [("one", "rush", "1-URGENT", ">", "two", 0.5, None, None), ("two", "slack", "5-LOW", "<", "three", None, -1.0, None), ("three", "volume", "2-HIGH", ">=", None, None, None, 20.0), ("three", "silence", "no such kpi", "<", "one", 2.0, None, None)]


@query(f"""WITH s AS (SELECT CASE o_custkey % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'two' ELSE 'three' END AS company, o_orderpriority AS kpi, count(*)::DOUBLE AS value FROM orders GROUP BY ALL),
p(company, pathology, kpi, op, ref, factor, points, n) AS (VALUES {', '.join('(' + ', '.join('NULL' if x is None else repr(x) for x in p) + ')' for p in _PLANTS)}),
b AS (SELECT p.company, p.pathology, p.kpi, p.op, coalesce(p.n, o.value * p.factor, o.value + p.points)::DOUBLE AS bound, s.value AS measured FROM p LEFT JOIN s USING (company, kpi) LEFT JOIN s o ON o.company = p.ref AND o.kpi = p.kpi)
SELECT company, pathology, kpi, bound, measured, coalesce(CASE op WHEN '>' THEN measured > bound WHEN '>=' THEN measured >= bound ELSE measured < bound END, FALSE) AS holds FROM b""")
def plant_verdicts(spark, t):
    """Whether what was planted in a company shows in its figures, against another company or a count."""
    company = F.element_at(F.array(F.lit("one"), F.lit("two"), F.lit("three")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("company")
    scores = t("orders").groupBy(company, F.col("o_orderpriority").alias("kpi")).agg(F.count("*").alias("value"))
    plants = spark.createDataFrame(_PLANTS, "company string, pathology string, kpi string, op string, ref string, factor double, points double, count double")
    return R.plant_verdicts(scores, plants)


@query("SELECT o_orderkey, o_orderkey // 200 AS block, CASE WHEN o_orderkey < 600 THEN 'again' ELSE 'first' END AS run FROM orders")
def checkpointed_blocks(spark, t):
    """Written in blocks, then the first three blocks once more; the others stay as they were."""
    path, d = scratch(spark, "blocks"), t("orders").select("o_orderkey")
    R.write_checkpointed(d.withColumn("run", F.lit("first")), path, "o_orderkey")
    R.write_checkpointed(d.filter("o_orderkey < 600").withColumn("run", F.lit("again")), path, "o_orderkey")
    return R.read_checkpointed(spark, path).select("o_orderkey", F.col("block").cast("long").alias("block"), "run")


@query("SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN sha256(html) ELSE 'old' END AS sha, CASE WHEN page_id % 2 = 0 THEN 'fetched' ELSE '' END AS note FROM pages")
def manifest_update(spark, t):
    """Hash and note of fetched pages join the manifest; the other rows keep what they have."""
    manifest = t("pages").select("page_id", "url", F.lit("old").alias("sha"))
    facts = t("pages").filter("page_id % 2 = 0").select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("sha"), F.lit("fetched").alias("note"))
    return R.updated(manifest, facts, "page_id", ["sha", "note"])


_POSITIONS = ("Superintendent", "Advisor", "Engineer", "Foreman", "Planner")


@query(f"""SELECT s_suppkey, 'SYN-' || substr(sha256(s_suppkey || '|s1'), 1, 6) AS name, ({list(_POSITIONS)})[{sql_mod("s_suppkey || '|position|s1'", 5)} + 1] AS position,
'SYN-OWN-' || substr(sha256(s_suppkey || 's2'), 1, 6) AS owner FROM supplier""")
def synthetic_persons(spark, t):
    k = F.col("s_suppkey")
    return t("supplier").select("s_suppkey", R.person(k, "s1", _POSITIONS).alias("p"), R.identity(k, "OWN", "s2").alias("owner")).select("s_suppkey", "p.*", "owner")


@query("""SELECT o_orderkey, coalesce(nullif(array_to_string(list_sort(list_filter([CASE WHEN o_orderstatus = 'F' THEN 'Fire' END, CASE WHEN o_custkey % 3 = 0 THEN 'Crane' END, CASE WHEN o_custkey % 5 = 0 THEN 'Blowout' END], lambda x: x IS NOT NULL)), ', '), ''), 'Unspecified') AS title FROM orders""")
def incident_titles(spark, t):
    types = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "F", "Fire"), F.when(F.col("o_custkey") % 3 == 0, "Crane"), F.when(F.col("o_custkey") % 5 == 0, "Blowout")))
    return t("orders").select("o_orderkey", R.incident_title(types).alias("title"))


_OUTCOME = {"Fatality": ("Health & Safety", "Injury Fatality"), "Injury": ("Health & Safety", None), "Pollution": ("Environment & Reputation", "Loss of Containment")}
_SCALE = {"Incident >$25K": ("Business Interruption & Cost", None)}
_MECHANISM = {"Fire": "Fire", "Crane": None, "Explosion": "Explosion"}
_ATOMS = ("Fatality", "Injury", "Pollution", "Incident >$25K", "Fire", "Crane", "Explosion", "Muster")


@query(f"""WITH r AS (SELECT o_orderkey, {sql_mod("'types|' || o_orderkey", 512)} AS r FROM orders),
a AS (SELECT o_orderkey, [({list(_ATOMS)})[r % 8 + 1], ({list(_ATOMS)})[(r // 8) % 8 + 1], ({list(_ATOMS)})[r // 64 + 1]] AS atoms FROM r),
u AS (SELECT o_orderkey, unnest(atoms) AS atom, unnest([1, 2, 3]) AS i FROM a),
k AS (SELECT *, CASE atom WHEN 'Fatality' THEN 0 WHEN 'Injury' THEN 1 WHEN 'Pollution' THEN 2 WHEN 'Incident >$25K' THEN 4 END AS rank FROM u),
w AS (SELECT o_orderkey, arg_min(atom, rank * 10 + i) FILTER (WHERE rank IS NOT NULL) AS top, arg_min(atom, i) FILTER (WHERE atom IN ('Fire', 'Explosion')) AS d, bool_or(atom <> 'Muster') AS happened FROM k GROUP BY 1)
SELECT o_orderkey, CASE WHEN happened THEN 'Loss Event' ELSE 'Near Hit' END AS type_a, CASE WHEN top IN ('Fatality', 'Injury') THEN 'Health & Safety' WHEN top = 'Pollution' THEN 'Environment & Reputation' WHEN top IS NOT NULL THEN 'Business Interruption & Cost' END AS type_b,
CASE top WHEN 'Fatality' THEN 'Injury Fatality' WHEN 'Pollution' THEN 'Loss of Containment' END AS type_c, d AS type_d FROM w""")
def incident_types(spark, t):
    """Types of three atoms drawn by hash; a null of the best-ranked one stays."""
    from caseledger.functions.hashing import draw

    names, r = F.array(*[F.lit(a) for a in _ATOMS]), draw(512, F.lit("types"), F.col("o_orderkey"))
    at = lambda x: F.element_at(names, (x + 1).cast("int"))
    atoms = F.array(at(r % 8), at(F.floor(r / 8) % 8), at(F.floor(r / 64)))
    return t("orders").select("o_orderkey", A.resolve_types(atoms, _OUTCOME, _SCALE, _MECHANISM, ["Muster"], A.PRECEDENCE).alias("t")).select("o_orderkey", "t.*")


@query("""SELECT o_orderkey, 'seen ' || strftime(d, '%B ') || day(d) || ', ' || year(d) || ' and ' || month(d) || '/' || day(d) || '/' || year(d) || '; ' || strftime(d, '%d-') || upper(strftime(d, '%b')) || strftime(d, '-%Y') AS text
FROM (SELECT o_orderkey, o_orderdate::DATE + (o_orderkey % 400 - 200)::INTEGER AS d FROM orders)""")
def prose_dates_by_delta(spark, t):
    """Dates in running text moved by each row's own delta."""
    day = F.col("o_orderdate").cast("date")
    text = F.concat(F.lit("seen "), F.date_format(day, "MMMM d, yyyy"), F.lit(" and "), F.date_format(day, "MM/dd/yyyy"), F.lit("; "), F.date_format(day, "d-MMM-yyyy"))
    return t("orders").select("o_orderkey", shift_prose_dates(text, (F.col("o_orderkey") % 400 - 200).cast("int")).alias("text"))


@query("""WITH c AS (SELECT conv_id, turn, CASE conv_id % 3 WHEN 2 THEN 'category ' || role || ', ' || text ELSE text END AS bare FROM conversations)
SELECT conv_id, turn, md5(trim(bare)) AS text FROM c WHERE len(list_filter(string_split_regex(trim(bare), '\\s+'), lambda w: w <> '')) >= 5""")
def stripped_statements(spark, t):
    """Statements without the head that names their own category, however it is marked off, so that a clustering cannot read
    the answer; a head without a mark stays. Five words or more."""
    head, m = F.concat(F.lit("category "), F.col("role")), F.col("conv_id") % 3
    d = t("conversations").withColumn("text", F.concat(head, F.when(m == 0, ": ").when(m == 1, " - ").otherwise(", "), F.col("text")))
    bare = F.trim(X.without_head(F.col("text"), head))
    return d.select("conv_id", "turn", F.md5(bare.cast("binary")).alias("text"), F.size(F.filter(F.split(bare, r"\s+"), lambda w: w != "")).alias("n")).filter("n >= 5").drop("n")


@query()
def cluster_sweep(spark, t):
    """Clusters of whole texts for k from 2 to 12, heads stripped and, as the circular control, kept: agreement with the
    language and with the source, silhouette, and the best k. The heads name the language."""
    from pyspark.ml.feature import StopWordsRemover

    from caseledger.operators import sweeps as W

    d = t("documents").select("doc_id", "lang", F.col("source").alias("era"), F.concat_ws(": ", F.upper(F.concat(F.lit("category "), "lang")), "text").alias("kept"))
    d = d.withColumn("stripped", X.without_head(F.col("kept"), F.upper(F.concat(F.lit("category "), "lang"))))
    stop, out = StopWordsRemover.loadDefaultStopWords("english"), None
    for mode in ("stripped", "kept"):
        path = scratch(spark, "vectors")
        rows = W.vectors(d.select("doc_id", F.col(mode).alias("text")), "doc_id", dims=1024, stop=stop, path=path)
        one = W.report(W.assign(rows, "doc_id", W.fit(rows, "doc_id", range(2, 13), restarts=2, rounds=8, dims=1024)), d, "doc_id", "lang", "era").withColumn("mode", F.lit(mode))
        discard(spark, path)  # the report is made; the disk holds one mode's vectors at a time
        out = one if out is None else out.unionByName(one)
    return out


@query()
def classifier_folds(spark, t):
    """Languages from hashed TF-IDF, three folds by hash fitted together: accuracy, macro F1 and the majority's of each fold."""
    from caseledger.operators import classify, sweeps

    d = t("documents").filter("lang is not null").select("doc_id", "lang", "text")
    rows = sweeps.vectors(d, "doc_id", dims=1024, max_share=0.7, keep=["lang"]).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int"))
    return classify.fold_scores(classify.predict(rows, "doc_id", "lang", classify.fit(rows, "lang", 3, steps=25, dims=1024)), "lang")
