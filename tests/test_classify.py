"""The distributed fit against the same steps in numpy and against the optimum, and its scores against a plain count."""

import numpy as np

from caseledger.operators import classify as C


def data(spark, n=150, dims=12):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, n)
    x = rng.random((n, dims)) * 0.4
    for i, c in enumerate(y):
        x[i, c * 4 : c * 4 + 4] += rng.random(4)
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    fold = np.arange(n) % 3
    rows = spark.createDataFrame([(i, list(range(dims)), x[i].tolist(), f"c{y[i]}", int(fold[i])) for i in range(n)], "id int, at array<int>, weight array<double>, label string, fold int").repartition(4)
    return x, y, fold, rows


def gradient(w, x, y, l2):
    p = C._softmax(x @ w[:-1] + w[-1])
    p[np.arange(len(y)), y] -= 1
    g = np.vstack([x.T @ p, p.sum(axis=0)]) / len(y)
    g[:-1] += l2 * w[:-1]
    return g


def test_fit_equals_the_optimum_of_every_fold(spark):
    x, y, fold, rows = data(spark)
    model = C.fit(rows, "label", 3, l2=0.05, steps=90, dims=12)
    for f in range(3):
        xs, ys = x[fold != f], y[fold != f]
        w = np.zeros((13, 3))
        for _ in range(8_000):
            w -= gradient(w, xs, ys, 0.05)
        assert np.abs(gradient(model.w[f], xs, ys, 0.05)).max() < 1e-6
        assert np.abs(C._softmax(xs @ w[:-1] + w[-1]) - C._softmax(xs @ model.w[f][:-1] + model.w[f][-1])).max() < 1e-4


def test_scores_equal_a_plain_count(spark):
    x, y, fold, rows = data(spark)
    said = C.predict(rows, "id", "label", C.fit(rows, "label", 3, steps=5, dims=12))
    got = {r["id"]: (r["label"], r["predicted"]) for r in said.collect()}
    for r in C.fold_scores(said, "label").collect():
        pairs = [got[i] for i in range(len(y)) if fold[i] == r["fold"]]
        names = sorted({a for a, _ in pairs} | {b for _, b in pairs})
        f1 = [2 * sum(a == b == c for a, b in pairs) / (sum(a == c for a, _ in pairs) + sum(b == c for _, b in pairs)) for c in names]
        most = max(sum(a == c for a, _ in pairs) for c in names)
        assert r["n"] == len(pairs) and abs(r["accuracy"] - sum(a == b for a, b in pairs) / len(pairs)) < 1e-6
        assert abs(r["macro_f1"] - sum(f1) / len(f1)) < 1e-6 and abs(r["baseline"] - most / len(pairs)) < 1e-6


def test_every_term_has_its_own_dimension_up_to_a_bound_that_the_driver_holds(spark):
    from caseledger.operators.learning import cross_validated

    words = {"en": "the pump has failed", "fr": "la pompe est tombee"}
    d = spark.createDataFrame([(i, f"{words[g]} {w}", g) for i in range(60) for g, w in [(("en", "fr")[i % 2], words[("en", "fr")[i % 2]].split()[i % 4])]], "doc_id long, text string, lang string")
    for wide in (64, 5):  # eight terms: one each, or dealt over five dimensions
        got = cross_validated(d, "lang", 2, wide=wide).orderBy("fold").collect()
        assert [r["fold"] for r in got] == [0, 1] and sum(r["n"] for r in got) == 60 and all(r["accuracy"] > 0.9 for r in got)


def test_labels_are_written_beside_vectors_over_the_tasks(spark):
    from caseledger.operators.sweeps import vectors

    d = spark.createDataFrame([(i, "pump failed hard" if i % 2 else "valve leaked oil", f"c{i % 2}") for i in range(200)], "id int, text string, label string").coalesce(1)
    rows = vectors(d, "id", dims=16, max_share=0.7, keep=["label"])
    assert rows.count() == 200 and rows.groupBy("label").count().count() == 2 and len(rows.inputFiles()) == 4
