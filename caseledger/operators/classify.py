"""Multinomial logistic regression with cross-validation, all folds in one pass a step.

Coefficients are as many as hashed dimensions times classes and folds, whatever the vocabulary. Each step is one pass: a task
adds up the gradients of its rows for every fold whose model may see them, Spark sums the tasks', and the driver takes an
accelerated step of the size that the loss's curvature allows, so there is no line search and no further pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.operators.sweeps import DIMS, dense, in_few

#: Bound on the loss's curvature for rows of unit length and a constant: half of their squared length.
CURVATURE = 1.0


@dataclass
class Folds:
    """Coefficients by fold, dimension (the last is the constant) and class, and the classes' names in order."""

    w: np.ndarray
    classes: list[str]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(row, fold, class) of rows as a matrix."""
        folds, dims, n = self.w.shape
        return (x @ self.w[:, :-1].transpose(1, 0, 2).reshape(dims - 1, folds * n)).reshape(len(x), folds, n) + self.w[:, -1]


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: DataFrame, label: str, folds: int, l2: float = 1e-3, steps: int = 60, dims: int = DIMS) -> Folds:
    """rows: at, weight, the label as a string and ``fold``, an integer below ``folds``. Each fold's model is fitted to the
    other folds' rows; its penalty, half l2 times the squared coefficients, leaves out the constant."""
    spark = rows.sparkSession
    sizes = {(r[label], r["fold"]): r["n"] for r in rows.groupBy(label, "fold").agg(F.count("*").alias("n")).collect()}
    classes = sorted({c for c, _ in sizes})
    number = {c: i for i, c in enumerate(classes)}
    seen = np.array([max(1, sum(n for (_, f), n in sizes.items() if f != k)) for k in range(folds)])
    w = ahead = np.zeros((folds, dims + 1, len(classes)))
    shrink = np.full((1, dims + 1, 1), l2)
    shrink[:, -1] = 0
    root = (l2 / (CURVATURE + l2)) ** 0.5  # the penalty bounds the curvature from below
    for step in range(steps):
        shared = spark.sparkContext.broadcast(Folds(ahead, classes))

        def run(batches, shared=shared):
            model = shared.value
            g = np.zeros_like(model.w)
            for b in batches:
                label, fold = np.array([number[c] for c in b.column(2).to_pylist()], dtype=int), b.column(3).to_numpy()
                for lo, x in dense(b.column(0), b.column(1), dims):
                    off, i = _softmax(model.scores(x)), np.arange(len(x))
                    off[i, :, label[lo : lo + len(x)]] -= 1
                    off[i, fold[lo : lo + len(x)]] = 0
                    g[:, :-1] += (x.T @ off.reshape(len(x), -1)).reshape(dims, folds, -1).transpose(1, 0, 2)
                    g[:, -1] += off.sum(axis=0)
            at = np.flatnonzero(g)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g.ravel()[at])], names=["at", "x"])

        got = in_few(rows.select("at", "weight", F.col(label).alias("_c"), F.col("fold").cast("int").alias("_f"))).mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
        g = np.zeros_like(w)
        g.ravel()[got.column("at").to_numpy()] = got.column("x").to_numpy()
        shared.unpersist()
        new = ahead - (g / seen[:, None, None] + shrink * ahead) / (CURVATURE + l2)
        ahead, w = new + min(step / (step + 3), (1 - root) / (1 + root)) * (new - w), new
    return Folds(w, classes)


def predict(rows: DataFrame, key: str, label: str, model: Folds) -> DataFrame:
    """(key, fold, label, predicted): every row by the model that did not see it; of equal scores the first class by name."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            fold, said = b.column(1).to_numpy(), []
            for lo, x in dense(b.column(3), b.column(4), m.w.shape[1] - 1):
                said += [m.classes[c] for c in m.scores(x)[np.arange(len(x)), fold[lo : lo + len(x)]].argmax(axis=1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(said, pa.string())], names=[key, "fold", label, "predicted"])

    return rows.select(key, F.col("fold").cast("int"), label, "at", "weight").mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, fold int, {label} string, predicted string")


def fold_scores(said: DataFrame, label: str) -> DataFrame:
    """(fold, n, accuracy, macro_f1, baseline, baseline_f1): a class that a fold neither holds nor predicts is no class of it; the
    baseline says the fold's most frequent class everywhere (of equal ones the first by name)."""
    cells = said.groupBy("fold", label, "predicted").agg(F.count("*").alias("n"))
    true = cells.groupBy("fold", F.col(label).alias("c")).agg(F.sum("n").alias("true"), F.sum(F.when(F.col(label) == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    got = cells.groupBy("fold", F.col("predicted").alias("c")).agg(F.sum("n").alias("got"))
    per = true.join(got, ["fold", "c"], "full_outer").fillna(0, ["true", "hit", "got"])
    most = F.max(F.struct("true", F.col("c")))["true"]
    d = per.groupBy("fold").agg(F.sum("true").alias("n"), F.sum("hit").alias("hit"), F.avg(2 * F.col("hit") / (F.col("true") + F.col("got"))).alias("f1"), most.alias("most"), F.count_if(F.col("true") > 0).alias("k"))
    top = F.col("most") / F.col("n")
    return d.select("fold", "n", F.round(F.col("hit") / F.col("n"), 6).alias("accuracy"), F.round("f1", 6).alias("macro_f1"), F.round(top, 6).alias("baseline"), F.round(2 * top / (1 + top) / F.col("k"), 6).alias("baseline_f1"))
