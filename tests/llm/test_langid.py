"""Language labels: Viterbi against all paths, n-gram counts against a plain count, held-out accuracy, odd rows."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from caseledger.llm import langid
from caseledger.llm.langid import BUCKETS, SCRIPTS, UND, Labeller, Model, count_features, features, language_scores, language_spans, learn, plain, viterbi, words_of

SF = "/root/testdata/sf0.01"
TEXTS = {
    "en": "the house on the hill was built with stones that the men of the village had carried there",
    "de": "das haus auf dem berg wurde mit steinen gebaut die von den leuten aus dem dorf dorthin getragen worden sind",
    "ru": "дом на холме был построен из камней которые принесли туда люди из деревни",
    "el": "το σπίτι στον λόφο χτίστηκε με πέτρες που μετέφεραν εκεί οι άνθρωποι του χωριού",
}


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def cost(s, path, penalty):
    return sum(s[i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    seqs = [rng.normal(0, 3, (n, 3)) for n in (1, 2, 5, 6, 3, 6, 1)]
    for s, p in zip(seqs, viterbi(seqs, 2.0), strict=True):
        best = max(cost(s, q, 2.0) for q in itertools.product(range(3), repeat=len(s)))
        assert cost(s, p.tolist(), 2.0) == pytest.approx(best)


def test_single_language_texts_skip_no_better_path():
    rng = np.random.default_rng(4)
    for n in range(1, 120):
        s = rng.normal(0, 2.5, (n, 4))
        top = int(s.sum(axis=0).argmax())
        if not Labeller._may_gain(s, top):
            assert cost(s, viterbi([s], langid.SWITCH)[0].tolist(), langid.SWITCH) == pytest.approx(s[:, top].sum())


def test_counts_equal_a_plain_count(spark):
    rows = [(1, "en", "Ab ab, c!"), (2, "en", "c d\u00e9j\u00e0 2024 \u2014"), (3, "ru", "\u0434\u043e\u043c \u0434\u043e\u043c"), (4, None, "zzz"), (5, "en", None)]
    got = {(r["lang"], r["slot"]): r["n"] for r in count_features(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)).collect()}
    want = Counter()
    for _, lang, text in rows:
        if lang and text:
            for w in words_of(text):
                f = features([w])
                want.update((lang, int(b)) for b in f.bucket)
                if f.letters[0]:
                    want[lang, BUCKETS + int(f.script[0])] += int(f.letters[0])
    assert got == dict(want)
    assert len(features(["ab"]).bucket) == 3 + 2 + 1 and plain("it's,") == "_it_s_" and not len(features(["2024"]).bucket)


def table(spark, extra=()):
    rows = [(i, lang, " ".join(np.random.default_rng(i).permutation(TEXTS[lang].split()))) for i, lang in enumerate(list(TEXTS) * 12)]
    return spark.createDataFrame([(*r, "x") for r in rows + list(extra)], "doc_id long, lang string, text string, score string")


def test_scripts_languages_and_odd_rows(spark):
    odd = [(900, None, None), (901, None, ""), (902, None, "12 34 !? \u00b2"), (903, None, "\u4f60\u597d"), (None, "de", "das haus"), (904, None, "THE HILL"), (905, None, "the house " * 40_000), (3, "el", TEXTS["el"])]
    df = table(spark, odd)
    out = language_scores(df)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == 48 + len(odd)
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == [UND] * 3 and got[900]["score"] == 0
    assert got[903]["lang_pred"] in TEXTS and got[904]["lang_pred"] == got[905]["lang_pred"] == "en"
    assert not got[None]["held_out"] and got[None]["lang_pred"] == "de"
    assert all(got[i]["lang_pred"] == lang for i, lang in enumerate(list(TEXTS) * 12))
    assert all(got[i]["held_out"] == held(i) and 0 <= got[i]["score"] <= 1 for i in range(48))
    model = learn(df)
    cyrillic = model.scripts[SCRIPTS.index("CYRILLIC")]
    assert [x for x, c in zip(model.langs, cyrillic, strict=True) if c] == ["ru"] and model.scripts[SCRIPTS.index("CJK")].all()


def test_spans_of_mixed_text(spark):
    parts = [("de", TEXTS["de"]), ("en", TEXTS["en"]), ("ru", TEXTS["ru"]), ("de", TEXTS["de"])]
    df = spark.createDataFrame([(1, " ".join(t for _, t in parts)), (2, None), (3, "77")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in language_spans(df, learn(table(spark))).collect()}
    at, want = 0, []
    for lang, t in parts:
        want.append((at, len(t.split()), lang))
        at += len(t.split())
    assert list(map(tuple, got[1])) == want and got[2] == [] and got[3] == []


def test_no_labels_and_empty_table(spark):
    schema = "doc_id long, lang string, text string"
    assert language_scores(spark.createDataFrame([], schema)).count() == 0
    got = language_scores(spark.createDataFrame([(1, None, "some words")], schema)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [(UND, 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in language_scores(docs).collect() if r["held_out"]]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in got)
    assert len(got) > 250 and right >= 0.98 * len(got)


def test_labels_of_held_out_rows_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, language_scores(docs).collect())) == sorted(map(tuple, language_scores(other).collect()))


def test_model_counts_share_unseen():
    m = Model.of_counts(["a", "b"], np.array([0, 1, 0, 1]), np.array([1, 2, BUCKETS + 1, BUCKETS + 1]), np.array([5, 500, 9, 9]))
    assert m.table[7, 0] == m.table[7, 1] and m.table[1, 0] > m.table[1, 1]
