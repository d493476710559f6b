"""CSV files of any size whose quoted cells may hold line ends, read by many tasks at once.

A line end inside quotes ends no record, and whether a byte range begins inside quotes is known only from all that lies
before it. So every range of a file first reports the parity of its quotes, and how many records would begin in it for
either answer; prefix sums over the ranges, one row each, then tell how each range really begins and the number of its first
record. With that, the ranges are cut into records independently. Only a record that crosses ranges is put together from
its parts by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.sources.files import strings


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(file, at, value): the lines of all ranges; a task reads its ranges in order, and a line belongs to where it begins."""
    text = spark.read.option("lineSep", "\n").option("encoding", encoding).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def _runs(b: pa.RecordBatch) -> list[tuple[str, int, int, int]]:
    """(file, range, first, end) of a batch's stretches of one range."""
    if not b.num_rows:
        return []
    f, at = b.column(0).dictionary_encode().indices.to_numpy(), b.column(1).to_numpy()
    edge = np.concatenate([[0], np.flatnonzero((f[1:] != f[:-1]) | (at[1:] != at[:-1])) + 1, [b.num_rows]])
    return [(b.column(0)[int(a)].as_py(), int(at[a]), int(a), int(z)) for a, z in zip(edge[:-1], edge[1:], strict=True)]


def _quotes(values: pa.Array) -> np.ndarray:
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _parities(batches):
    """One row a range: the parity of its quotes and the lines that begin outside quotes if it begins outside, or inside."""
    names = ["file", "at", "odd", "if_outside", "if_inside"]
    state: tuple[str, int] | None = None
    odd, counts = 0, [0, 0]
    for b in batches:
        for file, at, a, z in _runs(b):
            if state != (file, at):
                if state:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, [[state[0]], [state[1]], [odd], [counts[0]], [counts[1]]], strict=True)))
                state, odd, counts = (file, at), 0, [0, 0]
            q = np.cumsum(_quotes(b.column(2).slice(a, z - a)))
            before = (odd + np.concatenate([[0], q[:-1]])) % 2
            counts = [counts[0] + int((before == 0).sum()), counts[1] + int((before == 1).sum())]
            odd = (odd + int(q[-1])) % 2
    if state:
        yield pa.RecordBatch.from_pydict(dict(zip(names, [[state[0]], [state[1]], [odd], [counts[0]], [counts[1]]], strict=True)))


def _records(batches):
    """(file, number, part, text, whole) of the records and the parts of records in every range."""
    names = ["file", "number", "part", "text", "whole"]
    state: tuple[str, int] | None = None
    inside, number, pending = 0, 0, []  # the record that is open, or none: its lines so far and whether it began here
    began = False

    def out(file, at, rows):
        return pa.RecordBatch.from_pydict({"file": [file] * len(rows), "number": pa.array([r[0] for r in rows], pa.int64()), "part": pa.array([at] * len(rows), pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "whole": [r[2] for r in rows]}).select(names)

    def left():
        return [(number, "\n".join(pending), began and not inside)] if pending else []

    for b in batches:
        for file, at, a, z in _runs(b):
            if state != (file, at):
                if state and (rest := left()):
                    yield out(*state, rest)
                state, inside, number, pending, began = (file, at), b.column(3)[a].as_py(), b.column(4)[a].as_py() - 1, [], False
            values = b.column(2).slice(a, z - a)
            q = np.cumsum(_quotes(values))
            starts = np.flatnonzero((inside + np.concatenate([[0], q[:-1]])) % 2 == 0)
            lines = values.to_pylist()
            inside = (inside + int(q[-1])) % 2
            if not len(starts):
                pending += lines
                continue
            pending += lines[: starts[0]]
            rows = [(number, "\n".join(pending), began)] if pending else []
            edge = [*starts.tolist(), len(lines)]
            rows += [(number + 1 + k, lines[s] if e == s + 1 else "\n".join(lines[s:e]), True) for k, (s, e) in enumerate(zip(edge[:-2], edge[1:-1], strict=True))]
            number += len(starts)
            pending, began = lines[edge[-2] :], True
            if rows:
                yield out(file, at, rows)
    if state and (rest := left()):
        yield out(*state, rest)


def read_large_csv(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """As :func:`files.read_csv`: RFC 4180 quotes, every cell a string, blank cells "". Quotes stand around whole cells and
    doubled inside them. Each file's first record is its header; empty lines between records are skipped.

    The ranges are those of ``spark.sql.files.maxPartitionBytes``; their table, broadcast, has a row for each."""
    lines = _lines(spark, path, encoding)
    ranges = lines.mapInArrow(_parities, "file string, at long, odd long, if_outside long, if_inside long")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).withColumn("n", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    ranges = ranges.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = lines.join(F.broadcast(ranges.select("file", "at", "inside", "first")), ["file", "at"]).select("file", "at", "value", "inside", "first")
    records = placed.mapInArrow(_records, "file string, number long, part long, text string, whole boolean")
    parts = records.filter("not whole").groupBy("file", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "\n").alias("text"))
    every = records.filter("whole").select("file", "number", "text").unionByName(parts)
    if header:
        every = every.filter("number > 0")
    text = F.regexp_replace("text", r"\r$", "")
    cells = F.from_csv(text, strings([f"c{i}" for i in range(len(columns))]).simpleString()[7:-1].replace(":", " "), {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    d = every.filter(text != "").select(cells.alias("r"))
    return d.select(*[F.coalesce(F.col(f"r.c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)])
