"""Anchors, their anomalies, fields and revisions on small forms."""

import pytest

from caseledger.operators import segments as S

FORM = S.Form(
    {2: S.FormField("operator", ["OPERATOR"]), 3: S.FormField("agent", ["OPERATOR/AGENT"]), 9: S.FormField("cause", ["CAUSE"], "short"), 10: S.FormField("depth", ["WATER DEPTH"]), 18: S.FormField("probable", ["PROBABLE CAUSE"], "prose"),
     22: S.FormField("advice", ["RECURRANCE"], "prose"), 25: S.FormField("free", [], "prose")},
    limits={"short": 12}, cap=20, furniture=[r"PAGE:?\s*\d+"], watermarks=[r"\s*For Release\s*"], bleed=[r"\bNARRATIVE\s*:?"],
    depth_label="WATER DEPTH", depth_numbers={10: "C", 9: "AB"}, third_labels={"LEASE": "A", "OPERATOR/AGENT": "B"},
)


def lines(spark, *texts, doc=1):
    return spark.createDataFrame([(doc, i, t) for i, t in enumerate(texts)], "doc long, line int, text string")


def accepted(spark, *texts):
    a = S.accepted_anchors(S.resolved_anchors(lines(spark, *texts), FORM))
    return [(r["line"], r["start"], r["field"]) for r in a.orderBy("line", "k").collect()]


def anomalies(spark, *texts):
    return sorted((r["type"], r["field"], r["other"]) for r in S.anchor_anomalies(S.resolved_anchors(lines(spark, *texts), FORM)).collect())


def test_longer_label_wins_and_prose_opens_nothing(spark):
    assert accepted(spark, "7. OPERATOR/AGENT ON SITE", "14. OPERATOR: x", "4. CREW MEASURED WATER DEPTH", "see 10. water depth") == [(0, 0, 3), (1, 0, 2)]
    assert accepted(spark, "1. PROBABLE CAUSE OF IT:") == [(0, 0, 18)]
    # A label inside the text confirms the field's own number, and only that.
    assert accepted(spark, "9. THE PROBABLE CAUSE", "10. DEEP WATER DEPTH") == [(0, 0, 9), (1, 0, 10)]


def test_two_columns_repeats_and_order(spark):
    text = ["18. PROBABLE CAUSE: a   2 .  OPERATOR: b", "x18. PROBABLE CAUSE", "3. OPERATOR/AGENT: c", "2. OPERATOR: again", "99. OPERATOR"]
    assert accepted(spark, *text) == [(0, 0, 18), (0, 24, 2), (2, 0, 3)]
    assert anomalies(spark, *text) == [("duplicate_anchor", 2, None), ("out_of_order_anchor", 2, 18), ("out_of_order_anchor", 3, 18)]
    assert anomalies(spark, "12. WATER DEPTH: 3") == [("anchor_renumbered", 10, 12)]
    assert anomalies(spark, "25. Anything at all") == []


def test_fields_are_cut_between_anchors(spark):
    text = ["lead text", "2. OPERATOR: Acme 9. CAUSE: wear", "of seal", "  ", "22. AGAINST RECURRANCE", "NARRATIVE: keep", "  both   lines", "PAGE 3", "3. OPERATOR/AGENT: name For Release here and a long tail"]
    d = S.clean_lines(lines(spark, *text), FORM)
    f = S.form_fields(d, FORM)
    got = {r["field"]: (r["body"], r["bled"], r["overflow"]) for r in f.collect()}
    assert got == {2: ("Acme", 0, None), 9: ("wear\nof seal", 0, None), 22: ("22. AGAINST RECURRANCE\nkeep\nboth lines", 1, None), 3: ("name here and a long", 0, " tail")}
    odd = sorted((r["type"], r["field"], r["n"]) for r in S.field_anomalies(f, d, FORM).collect())
    assert odd == [("fields_not_located", None, 3), ("label_bleed_stripped", 22, 1), ("terminal_anchor_truncated", 3, 5)]


def test_no_anchor_and_empty_table(spark):
    d = lines(spark, "nothing here", "1.5 metres")
    f = S.form_fields(d, FORM)
    assert f.count() == 0 and [(r["type"], r["n"]) for r in S.field_anomalies(f, d, FORM).collect()] == [("no_anchors_found", 0)]
    assert S.form_fields(lines(spark), FORM).count() == 0 and S.form_revision(lines(spark), FORM).count() == 0


@pytest.mark.parametrize("text,revision", [
    (["10. WATER DEPTH: 9"], "C"), (["9. WATER DEPTH: 9"], "A"), (["9. WATER DEPTH", "3. OPERATOR/AGENT"], "B"), (["3. LEASE: 5", "9. WATER DEPTH"], "A"),
    (["9. WATER DEPTH", "3. SOMETHING"], "unknown"), (["3. LEASE"], "A"), (["8. WATER DEPTH"], "unknown"), (["9. WATER DEPTH", "10. WATER DEPTH"], "A"), (["no form"], "unknown"),
])
def test_revisions(spark, text, revision):
    assert S.form_revision(lines(spark, *text), FORM).collect()[0]["revision"] == revision


def plan(d):
    return d._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_cleaned_once(spark):
    assert plan(S.printed_anchors(S.clean_lines(lines(spark, "2. OPERATOR: x"), FORM))).count("For Release") == 1


def test_labels_are_data_and_not_a_chain_of_conditions(spark):
    a = S.resolved_anchors(lines(spark, "2. OPERATOR: x"), FORM)
    assert plan(a).count("CASE WHEN") <= 2
    assert [r["field"] for r in a.collect()] == [2]


def test_anchors_are_read_no_more_than_twice_for_their_anomalies(spark):
    assert plan(S.anchor_anomalies(S.resolved_anchors(lines(spark, "2. OPERATOR: x"), FORM))).count("LogicalRDD") == 2


def test_fields_are_cut_once_for_their_anomalies(spark):
    d = lines(spark, "2. OPERATOR: x")
    assert plan(S.field_anomalies(S.form_fields(d, FORM), d, FORM)).count("LogicalRDD") == 3
