"""Small helpers that no query shows alone."""

import json

import pytest
from pyspark.sql import functions as F

from caseledger.functions import dates as D
from caseledger.functions import text as X
from caseledger.sources import files


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


def test_texts(spark):
    assert one(spark, X.first_match(r"n\d+", F.col("a"), F.col("b")), a="none", b="see n12") == "n12"
    assert one(spark, X.strip_glyphs(F.col("a")), a="(cid:12) go (cid:3)") == "\u2022 go \u2022"
    assert one(spark, X.is_label_fragment(F.col("a"), ["OF ACCIDENT"]), a=" OF ACCIDENT ") and not one(spark, X.is_label_fragment(F.col("a"), ["OF ACCIDENT"]), a="of accident")
    assert one(spark, X.control_safe(F.col("a")), a="a\x00\x07b\tc") == "a b\tc"
    assert [one(spark, D.year_of(F.col("a")), a=x) for x in ("2021-05-01", "x2021", None)] == [2021, None, None]
    text = "He was flown to town in the evening. Nothing. He was flown to."
    assert one(spark, X.last_sentence_with(F.col("a"), "flown to"), a=text) is None
    assert one(spark, X.last_sentence_with(F.col("a"), "flown to"), a=text[:-19]) == "He was flown to town in the evening."


def test_reports_and_manifests(spark):
    d = spark.createDataFrame([(1, "a|b"), (2, None)], "i int, v string")
    assert files.markdown(d) == "| i | v |\n| --- | --- |\n| 1 | a\\|b |\n| 2 |  |\n"
    with pytest.raises(ValueError, match="1 rows"):
        files.markdown(d, limit=1)
    text = files.manifest_text({"b": 1, "a": {"d": [1], "c": None}})
    assert text.endswith("\n") and text.index('"a"') < text.index('"b"') and json.loads(text) == {"a": {"c": None, "d": [1]}, "b": 1}


def test_rule_tables(spark):
    got = files.rules(spark, [{"id": 1, "tag": "x"}, {"id": 2, "tag": "y", "more": 3}], ["id", "tag"])
    assert [tuple(r) for r in got.orderBy("ord").collect()] == [(0, "1", "x", None), (1, "2", "y", "3")]
    with pytest.raises(KeyError, match="tag"):
        files.rules(spark, [{"id": 1}], ["id", "tag"])
    assert files.load_yaml("a: 1\nb: [x]", ["a"]) == {"a": 1, "b": ["x"]}
    with pytest.raises(KeyError, match="c"):
        files.load_yaml("a: 1", ["c"])
