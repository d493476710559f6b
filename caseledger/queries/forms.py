"""Numbered form text: lines written from orders, read back into anchors, anomalies, revisions and fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.operators import segments as S
from caseledger.queries.base import query

#: An order form: CARRIER opens CARRIER/AGENT, DELAY lies inside PROBABLE DELAY, field 9 has two wordings, field 11 none.
FORM = S.Form(
    fields={
        1: S.FormField("ordered", ["ORDERED"], "date"), 2: S.FormField("carrier", ["CARRIER"]), 3: S.FormField("agent", ["CARRIER/AGENT"]), 4: S.FormField("clerk", ["CLERK"], "short"),
        5: S.FormField("returned", ["RETURN FLAG"], "short"), 6: S.FormField("probable", ["PROBABLE DELAY"], "prose"), 7: S.FormField("delay", ["DELAY"], "prose"), 8: S.FormField("depth", ["STOCK DEPTH"]),
        9: S.FormField("filed", ["FILED", "Report"], "short"), 10: S.FormField("tax", ["TAX (TOTAL)"]), 11: S.FormField("open"),
    },
    limits={"date": 40, "short": 24}, cap=60, furniture=["PAGE \\d+ OF", "APPROVED$"], watermarks=["FOR RELEASE"], bleed=["STOCK\\s+ABOVE\\s*:?", "CAUSED BY"],
    depth_label="STOCK DEPTH", depth_numbers={8: "C", 7: "AB"}, third_labels={"CARRIER/AGENT": "B", "CLERK": "A"},
)

_LABELS = ["ORDERED ON", "CARRIER", "CARRIER/AGENT name", "CLERK", "RETURN FLAG", "PROBABLE DELAY (IN DAYS)", "DELAY", "STOCK DEPTH", "Report FILED", "TAX (TOTAL)", "OPEN FIELD", "NOT OF THIS FORM", "the carrier moved"]


def _case(key: str, values) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _anchor(label_key: str, number_key: str, value: str) -> str:
    """A number, now the label's own and now another, the label, with and without a colon, and a value."""
    number = f"CASE WHEN {number_key} % 3 = 0 THEN {number_key} % 16 ELSE {label_key} % 13 + 1 END"
    point = f"CASE {number_key} % 7 WHEN 0 THEN ' .  ' ELSE '. ' END"
    return f"CAST({number} AS VARCHAR(9)) || {point} || {_case(f'{label_key} % 13', _LABELS)} || CASE {number_key} % 5 WHEN 1 THEN ' ' ELSE ': ' END || {value}"


_P, _S, _Q = "(o_orderkey * 31 + o_custkey)", "(o_orderkey * 17 + o_custkey * 5)", "(o_orderkey * 7 + o_custkey * 3)"

#: Lines of a form in SQL that both engines read: prose, furniture, watermarks, one or two anchors in a line.
TEXT_SQL = f"""CASE
 WHEN {_P} % 11 = 0 THEN 'PAGE ' || CAST(o_orderkey AS VARCHAR(9)) || ' OF 7'
 WHEN {_P} % 11 = 1 THEN '  stock above: caused by ' || o_orderpriority || '   in  12. quarters and FOR RELEASE 3.5 parts '
 WHEN {_P} % 11 <= 6 THEN {_anchor(_P, _S, "o_orderpriority || ' of order ' || CAST(o_orderkey AS VARCHAR(9))")}
 WHEN {_P} % 11 = 7 THEN 'FOR RELEASE ' || {_anchor(_S, _P, "o_orderpriority || ' Stock Above: ' || o_orderstatus || ', on ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))")}
 ELSE {_anchor(_P, _S, 'o_orderpriority')} || '  ' || {_anchor(_Q, _P, 'o_orderstatus')} END"""

# The oracle marks anchors with control characters and cuts at these; the rules of labels are one row per label.
_HINTS = ", ".join(f"({n}, upper('{x}'), {i})" for i, (n, x) in enumerate((n, x) for n, f in FORM.fields.items() for x in f.labels))
_SQL = f"""WITH raw AS (SELECT o_custkey AS doc, o_orderkey AS line, {TEXT_SQL} AS text FROM orders),
l AS (SELECT doc, line, trim(regexp_replace(replace(trim(text), 'FOR RELEASE', ' '), '\\s{{2,}}', ' ', 'g')) AS text FROM raw WHERE NOT regexp_matches(trim(text), '^(PAGE \\d+ OF|APPROVED$)')),
hints(num, hint, ord) AS (VALUES {_HINTS}),
m AS (SELECT *, string_split(regexp_replace(text, '(^|\\s)(\\d{{1,2}})(\\s*\\.\\s+)([A-Z(])', '\\1' || chr(1) || '\\2\\3' || chr(2) || '\\4', 'g'), chr(1)) AS p FROM l),
e AS (SELECT doc, line, text, p, unnest(range(1, len(p))) AS k FROM m),
a AS (SELECT doc, line, text, k, regexp_extract(p[k + 1], '^\\d+')::INTEGER AS printed, length(replace(array_to_string(p[1:k], ''), chr(2), ''))::INTEGER AS start,
      substr(replace(substr(array_to_string(p[k + 1:], ''), strpos(array_to_string(p[k + 1:], ''), chr(2)) + 1), chr(2), ''), 1, 90) AS tail FROM e),
own AS (SELECT a.*, (printed = 11 OR EXISTS (FROM hints h WHERE h.num = printed AND contains(upper(tail), hint))) AS ok,
        (SELECT arg_min(num, -length(hint) * 1000 + ord) FROM hints WHERE starts_with(ltrim(upper(tail), ' .:-'), hint)) AS named FROM a WHERE printed BETWEEN 1 AND 11),
r AS (SELECT *, CASE WHEN ok THEN printed ELSE named END AS field FROM own WHERE ok OR named IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY doc, field ORDER BY line, k) AS turn FROM r),
f AS (SELECT *, coalesce(max(field) OVER (PARTITION BY doc ORDER BY line, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS highest FROM t WHERE turn = 1)"""


def _lines(t):
    return S.clean_lines(t("orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line"), F.expr(TEXT_SQL).alias("text")), FORM)


@query(_SQL + """ SELECT doc, line, k::INTEGER AS k, 'anchor_renumbered' AS type, field, printed AS other, substr(text, 1, 120) AS shown FROM t WHERE field <> printed
UNION ALL SELECT doc, line, k::INTEGER, 'duplicate_anchor', field, NULL, substr(text, 1, 120) FROM t WHERE turn > 1
UNION ALL SELECT doc, line, k::INTEGER, 'out_of_order_anchor', field, highest, substr(text, 1, 120) FROM f WHERE field < highest""")
def anchor_anomalies(spark, t):
    """Renumbered, repeated and out-of-order anchors of forms written from all orders."""
    return S.anchor_anomalies(S.resolved_anchors(_lines(t), FORM))


@query(_SQL + " SELECT doc, string_agg(field || '@' || line || '/' || start, ',' ORDER BY line, k) AS fields FROM f GROUP BY doc")
def anchor_scan(spark, t):
    """The accepted anchors of every form, in order: a label outweighs its number, and a field's first anchor counts."""
    a = S.accepted_anchors(S.resolved_anchors(_lines(t), FORM))
    spots = F.array_sort(F.collect_list(F.struct("line", "k", "field", "start")))
    text = F.transform(spots, lambda x: F.concat(x["field"].cast("string"), F.lit("@"), x["line"].cast("string"), F.lit("/"), x["start"].cast("string")))
    return a.groupBy("doc").agg(F.array_join(text, ",").alias("fields"))


@query(_SQL + """, d AS (SELECT DISTINCT doc FROM l), v AS (SELECT doc, arg_min(printed, line * 100 + k) AS n FROM a WHERE contains(upper(tail), 'STOCK DEPTH') AND printed IN (7, 8) GROUP BY 1),
h AS (SELECT doc, arg_min(upper(tail), line * 100 + k) AS third FROM a WHERE printed = 3 GROUP BY 1)
SELECT doc, CASE WHEN n = 8 THEN 'C' WHEN contains(third, 'CARRIER/AGENT') THEN 'B' WHEN contains(third, 'CLERK') THEN 'A' WHEN n = 7 AND third IS NULL THEN 'A' ELSE 'unknown' END AS revision
FROM d LEFT JOIN v USING (doc) LEFT JOIN h USING (doc)""")
def form_revision(spark, t):
    """Read from the raw anchors: the number of the depth label, and where two revisions share it the label under 3."""
    return S.form_revision(_lines(t), FORM)


_FIELDS = _SQL + """, own_part AS (SELECT doc, field, line, start, TRUE AS opens, substr(text, start + 1, coalesce(lead(start) OVER (PARTITION BY doc, line ORDER BY k), length(text)) - start) AS part FROM f),
inherits AS (SELECT l.doc, l.line, substr(l.text, 1, coalesce((SELECT min(start) FROM f WHERE f.doc = l.doc AND f.line = l.line), length(l.text))) AS part, (SELECT arg_max(field, line * 100 + k) FROM f WHERE f.doc = l.doc AND f.line < l.line) AS field FROM l),
parts AS (SELECT doc, field, line, start, opens, part FROM own_part UNION ALL SELECT doc, field, line, 0, FALSE, part FROM inherits WHERE field IS NOT NULL),
b0 AS (SELECT doc, field, trim(string_agg(CASE WHEN opens AND strpos(part, ':') > 0 THEN substr(part, strpos(part, ':') + 1) ELSE part END, chr(10) ORDER BY line, start)) AS body FROM parts GROUP BY ALL),
b1 AS (SELECT *, len(regexp_extract_all(body, '(?i)STOCK\\s+ABOVE\\s*:?')) AS n1, regexp_replace(body, '(?i)STOCK\\s+ABOVE\\s*:?', ' ', 'g') AS body1 FROM b0),
b2 AS (SELECT doc, field, (n1 + len(regexp_extract_all(body1, '(?i)CAUSED BY')))::INTEGER AS bled, regexp_replace(body1, '(?i)CAUSED BY', ' ', 'g') AS body FROM b1),
b3 AS (SELECT doc, field, bled, array_to_string(list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS body,
       row_number() OVER (PARTITION BY doc ORDER BY (SELECT max(line * 100 + k) FROM f WHERE f.doc = b2.doc AND f.field = b2.field) DESC) = 1 AS last FROM b2),
b4 AS (SELECT *, CASE WHEN field = 1 THEN 40 WHEN field IN (4, 5, 9) THEN 24 ELSE 60 END AS cap FROM b3),
g AS (SELECT doc, field, CASE WHEN last THEN substr(body, 1, cap) ELSE body END AS body, bled, CASE WHEN last AND length(body) > cap THEN substr(body, cap + 1) END AS overflow FROM b4)"""


@query(_FIELDS + " SELECT * FROM g")
def form_fields(spark, t):
    """Every field's text between anchors, label text removed, the last one bounded with its overflow kept."""
    return S.form_fields(_lines(t), FORM)


@query(_FIELDS + """ SELECT doc, 'label_bleed_stripped' AS type, field, bled::BIGINT AS n FROM g WHERE bled > 0
UNION ALL SELECT doc, 'terminal_anchor_truncated', field, length(overflow) FROM g WHERE overflow IS NOT NULL
UNION ALL SELECT doc, 'field_length_exceeded', field, length(body) FROM g WHERE length(body) > CASE WHEN field = 1 THEN 40 WHEN field IN (4, 5, 9) THEN 24 END
UNION ALL SELECT doc, 'fields_not_located', NULL, 11 - count(*) FROM g GROUP BY doc HAVING count(*) < 11
UNION ALL SELECT doc, 'no_anchors_found', NULL, 0 FROM (SELECT DISTINCT doc FROM l) WHERE doc NOT IN (SELECT doc FROM g)""")
def field_anomalies(spark, t):
    """What cutting the fields has to report."""
    lines = _lines(t)
    return S.field_anomalies(S.form_fields(lines, FORM), lines, FORM)
