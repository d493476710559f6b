"""Page layout from word boxes: nearest labels, covering bands, reading order, disjoint matches."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def labels_of_marks(marks: DataFrame, words: DataFrame, page: str, row: float = 4, reach: float = 40, walk: float = 12) -> DataFrame:
    """(page, mark, label): words on the mark's row, the first within ``reach`` to its right, then on while gaps stay
    within ``walk``. marks: page, mark, x, y; words: page, text, x0, x1, y. Rows meet by bins of the row height."""
    bin_ = lambda c: F.floor(F.col(c) / row)
    m = marks.select(page, "mark", F.col("x").alias("_mx"), F.col("y").alias("_my"), F.explode(F.array(bin_("y") - 1, bin_("y"), bin_("y") + 1)).alias("_b"))
    w = words.select(page, "text", "x0", "x1", F.col("y").alias("_wy"), bin_("y").alias("_b"))
    near = m.join(w, [page, "_b"]).filter((F.abs(F.col("_my") - F.col("_wy")) <= row) & (F.col("x0") >= F.col("_mx")))
    rows = near.groupBy(page, "mark", "_mx").agg(F.array_sort(F.collect_list(F.struct("x0", "x1", "text"))).alias("ws"))  # one printed row
    empty = F.array().cast("array<string>")
    state = F.struct(F.col("_mx").cast("double").alias("end"), F.lit(True).alias("open"), empty.alias("out"))

    def step(a, x):
        ok = a["open"] & (x["x0"] - a["end"] <= F.when(F.size(a["out"]) == 0, reach).otherwise(walk))
        return F.struct(F.when(ok, x["x1"].cast("double")).otherwise(a["end"]).alias("end"), ok.alias("open"), F.when(ok, F.concat(a["out"], F.array(x["text"]))).otherwise(a["out"]).alias("out"))

    return rows.select(page, "mark", F.aggregate("ws", state, step, lambda a: F.array_join(a["out"], " ")).alias("label"))


#: Places looked at for a gutter, in points, and padded rows of pages that are scanned at once.
GUTTERS, ROWS_AT_ONCE = range(240, 371), 8_000


def _bands(pages: list[list[dict]], share: float, least: int, anchors: int) -> list[tuple[int, int, int, int]]:
    """(page, gutter, first, last) row indexes of many pages at once: one step over the rows serves every page and gutter.

    A band opens at a row that the gutter does not cross and grows while crossed rows are at most ``share`` of it; crossed
    rows at its end do not count. Of the bands that hold a row, the longest wins, of equal ones the leftmost."""
    xs, depth = np.array(GUTTERS), max(map(len, pages))
    n, w = len(pages), len(xs)
    crossed = np.ones((n, depth + 1, w), dtype=bool)  # below a page's end every row counts as crossed
    beside = np.zeros((2, n, depth + 1, w), dtype=np.int32)  # rows so far with words left and right of the gutter
    marks = np.zeros((n, depth + 1), dtype=np.int32)
    for p, rows in enumerate(pages):
        for k, r in enumerate(rows):
            lo, hi = np.array([s["x0"] for s in r["spans"]], dtype=float), np.array([s["x1"] for s in r["spans"]], dtype=float)
            crossed[p, k] = ((lo[:, None] < xs) & (xs < hi[:, None])).any(axis=0)
            beside[0, p, k + 1], beside[1, p, k + 1] = (hi[:, None] <= xs).any(axis=0), (lo[:, None] >= xs).any(axis=0)
            marks[p, k + 1] = bool(r["anchor"])
    beside, marks = beside.cumsum(axis=2), marks.cumsum(axis=1)
    opened, bad, good = np.full((n, w), -1), np.zeros((n, w), dtype=int), np.zeros((n, w), dtype=int)
    length = np.zeros((n, depth + 2, w), dtype=np.int32)  # changes of the covering band's length from row to row
    size = np.array([len(rows) for rows in pages])
    for k in range(depth + 1):
        c = crossed[:, k]
        bad += c
        ends = (opened >= 0) & ((c & (bad > share * (k - opened + 1))) | (k >= size)[:, None])
        p, x = np.nonzero(ends)
        first, last = opened[p, x], good[p, x]
        whole = (last - first + 1 >= least) & (marks[p, last + 1] - marks[p, first] >= anchors)
        for side in beside:
            whole &= side[p, last + 1, x] > side[p, first, x]
        p, x, first, last = p[whole], x[whole], first[whole], last[whole]
        length[p, first, x] += last - first + 1
        length[p, last + 1, x] -= last - first + 1
        opened[ends] = -1
        starts = (opened < 0) & ~c & (k < size)[:, None]
        opened[starts], bad[starts] = k, 0
        good[~c] = k
    length = length.cumsum(axis=1)
    gutter = np.where(length.max(axis=2) > 0, xs[length.argmax(axis=2)], -1)
    out = []
    for p in range(n):
        g = gutter[p, : len(pages[p])]
        edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]])) if len(g) else np.zeros(1, dtype=int)
        out += [(p, int(g[a]), int(a), int(b - 1)) for a, b in zip(edge[:-1], edge[1:], strict=True) if g[a] >= 0 and b - a >= least]
    return out


def covering_bands(rows: DataFrame, page: str, share: float = 0.15, least: int = 3, anchors: int = 2) -> DataFrame:
    """(page, gutter, first, last): runs of rows whose longest band has the same gutter. rows: page, row, spans
    array<struct<x0, x1>>, anchor (whether the row opens a field); a page, bounded by its paper, meets in one row, and pages
    go through one kernel many at a time. Bands need ``least`` rows, ``anchors`` of them anchors, and words on both sides."""

    def run(batches):
        for b in batches:
            names, pages = b.column(0), b.column(1).to_pylist()
            order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
            while order:
                part = [order.pop()]
                most = len(pages[part[0]])
                while order and most * (len(part) + 1) <= ROWS_AT_ONCE:
                    part.append(order.pop())
                found = _bands([pages[i] for i in part], share, least, anchors)
                numbers = [(g, pages[part[p]][a]["row"], pages[part[p]][z]["row"]) for p, g, a, z in found]
                cells = list(zip(*numbers, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([names.take(pa.array([part[p] for p, *_ in found], pa.int64())), pa.array(cells[0], pa.int32()), pa.array(cells[1], pa.int64()), pa.array(cells[2], pa.int64())], names=[page, "gutter", "first", "last"])

    lines = F.struct(F.col("row").cast("long").alias("row"), F.coalesce("spans", F.array().cast(rows.schema["spans"].dataType)).alias("spans"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    whole = rows.groupBy(page).agg(F.array_sort(F.collect_list(lines)).alias("rows"))
    return whole.mapInArrow(run, f"{page} {rows.schema[page].dataType.simpleString()}, gutter int, first long, last long")


def reading_order(lines: DataFrame, page: str) -> DataFrame:
    """(page, text): bands from top to bottom, the left column of a band before its right one."""
    parts = F.array_sort(F.collect_list(F.struct("band", "column", "top", "text")))
    return lines.groupBy(page).agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("text"))


def _chosen(spans: list[tuple]) -> list[tuple]:
    """Spans in order of (priority, start), each kept if it overlaps none that was: the kept ones stand in order of place, so
    the only one that can overlap is the last that begins before the span's end."""
    starts, kept = [], []
    for s in sorted(spans, key=lambda s: s[:4]):
        k = bisect_left(starts, s[2])
        if k and kept[k - 1][2] > s[1]:
            continue
        k = bisect_left(starts, s[1])
        while k < len(starts) and starts[k] == s[1] and kept[k][2] <= s[1]:
            k += 1
        starts.insert(k, s[1])
        kept.insert(k, s)
    return kept


#: Kept matches that leave a task at once.
KEPT_AT_ONCE = 20_000


def disjoint_matches(spans: DataFrame, group: str) -> DataFrame:
    """Matches in order of (priority, start), each dropped if it overlaps one that was kept.

    Matches that no chain of overlaps connects do not see each other: a group is cut where a match begins at or after
    everything before it has ended, and its parts are dealt over tasks. A part stays in its task alone, n log n."""
    d = spans.select(group, F.col("priority").cast("int").alias("priority"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "what")
    w = Window.partitionBy(group).orderBy("start", "end")
    until = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_new", (until.isNull() | (F.col("start") >= until)).cast("int")).withColumn("_part", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    alone = d.groupBy(group, "_part").agg(F.collect_list(F.struct("priority", "start", "end", "what")).alias("spans"))

    def cells(b, at, out):
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array([s[k] for s in out], t) for k, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.int32()), (4, pa.string()))]], names=[group, "priority", "start", "end", "what"])

    def run(batches):
        for b in batches:
            at, out = [], []
            for i, found in enumerate(b.column(1)):  # one part at a time is unpacked, and results leave by KEPT_AT_ONCE
                priority, start, end, what = (c.to_pylist() for c in found.values.flatten())
                kept = _chosen(list(zip(priority, start, end, [w or "" for w in what], what, strict=True)))
                at += [i] * len(kept)
                out += kept
                if len(out) >= KEPT_AT_ONCE:
                    yield cells(b, at, out)
                    at, out = [], []
            yield cells(b, at, out)

    return alone.select(group, "spans").mapInArrow(run, f"{group} {spans.schema[group].dataType.simpleString()}, priority int, start int, end int, what string")
