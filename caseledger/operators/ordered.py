"""Order-dependent operators: numbering, ranks, islands, restarts, fills, folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.functions.hashing import sha_hex
from caseledger.sources.files import scratch


def ordinal(df: DataFrame, parent: Sequence[str], order: Sequence[str], name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*parent).orderBy(*order)))


def hash_rank(df: DataFrame, ident: str, name: str = "rank") -> DataFrame:
    """1-based rank of every row by sha256(identifier), ties by identifier.

    Ranks are counted in 4,096 bins of the digest: a bin's row numbers plus the exact count of the bins before it (a
    broadcast of at most 4,096 rows), so no task ever sorts the whole table."""
    keyed = df.withColumn("_h", sha_hex(F.col(ident))).withColumn("_bin", F.substring("_h", 1, 3))
    sizes = keyed.groupBy("_bin").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_bin", "_before")
    inside = F.row_number().over(Window.partitionBy("_bin").orderBy("_h", ident))
    return keyed.withColumn("_r", inside).join(F.broadcast(before), "_bin").withColumn(name, F.col("_before") + F.col("_r")).drop("_h", "_bin", "_r", "_before")


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def water_fill(sizes: dict[str, int], budget: int, least: int = 1) -> dict[str, int]:
    """Equal shares capped by size; what is left goes one each per round, largest unused first, stable by name."""
    names = sorted(sizes)
    if not names:
        return {}
    base = max(least, budget // len(names))
    out = {n: min(base, sizes[n]) for n in names}
    left = budget - sum(out.values())
    while left > 0:
        spare = sorted((n for n in names if sizes[n] > out[n]), key=lambda n: -(sizes[n] - out[n]))
        if not spare:
            break
        for n in spare[:left]:
            out[n] += 1
        left -= len(spare[:left])
    return out


def water_fill_sample(df: DataFrame, group: str, ident: str, budget: int, least: int = 1) -> DataFrame:
    """Rows of each group up to its allocation, in hash order; rows of a null group are left out.

    The driver sees one count per group. A group's rows are counted in 4,096 digest bins; only bins that begin below the
    allocation are sorted, each by itself, so no task sorts a whole group."""
    sizes = {r[group]: r["n"] for r in df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n")).collect()}
    alloc = df.sparkSession.createDataFrame(sorted(water_fill(sizes, budget, least).items()), f"{group} string, _alloc long")
    keyed = df.withColumn("_h", sha_hex(F.col(ident))).withColumn("_bin", F.substring("_h", 1, 3))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = keyed.groupBy(group, "_bin").agg(F.count("*").alias("_n")).withColumn("_before", before)
    begun = bins.join(alloc, group).filter("_before < _alloc").drop("_n")
    inside = F.row_number().over(Window.partitionBy(group, "_bin").orderBy("_h", ident))
    return keyed.join(begun, [group, "_bin"]).withColumn("_rn", inside).filter("_before + _rn <= _alloc").drop("_h", "_bin", "_before", "_alloc", "_rn")


def islands(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, first, last, n) of runs of consecutive integers."""
    w = Window.partitionBy(*group).orderBy(value)
    d = df.select(*group, value).distinct().withColumn("_k", F.col(value) - F.row_number().over(w))
    return d.groupBy(*group, "_k").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("_k")


def restart_runs(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str = "run") -> DataFrame:
    """Run number that rises where the value does not exceed the one before; a null value starts anew as well."""
    w = Window.partitionBy(*group).orderBy(*order)
    prev = F.lag(value).over(w)
    flag = F.when(prev.isNull() | F.col(value).isNull() | (F.col(value) <= prev), 1).otherwise(0)
    return df.withColumn("_f", flag).withColumn(name, F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_f")


def forward_fill(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def _in_parts(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with ``_part``: ranges of (group, order), so that a group of any size is several parts in its order. Written to the
    shared folder, since what follows reads the parts more than once and they must not move between."""
    path = scratch(df.sparkSession, "parts")
    df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _carried(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Only groups of more than one part carry anything on; those are at most as many as there are parts."""
    return parts.withColumn("_k", F.count("*").over(Window.partitionBy(*group))).filter("_k > 1").drop("_k")


def _with_carried(d: DataFrame, carried: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    names = {g: f"_g{i}" for i, g in enumerate(group)}
    right = carried.select(*[F.col(g).alias(n) for g, n in names.items()], F.col("_part").alias("_p"), *columns)
    same = F.col("_part") == F.col("_p")
    for g, n in names.items():
        same &= F.col(g).eqNullSafe(F.col(n))
    return d.join(F.broadcast(right), same, "left").drop("_p", *names.values())


def forward_fill_in_parts(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """As :func:`forward_fill` for groups of any size: a part fills itself, and what stays open in it takes the last value of the
    group's parts before it."""
    d = _in_parts(df.withColumn("_v", value), group, order)
    lasts = d.filter("_v is not null").groupBy(*group, "_part").agg(F.max(F.struct(*order, "_v"))["_v"].alias("_v"))
    every = d.select(*group, "_part").distinct().join(lasts.select(*[F.col(g).alias(f"_l{i}") for i, g in enumerate(group)], F.col("_part").alias("_lp"), "_v"), _same(group, "_l", "_lp"), "left")
    before = F.last("_v", ignorenulls=True).over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    carried = _carried(every.select(*group, "_part", before.alias("_c")), group)
    w = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = _with_carried(d.withColumn("_own", F.last("_v", ignorenulls=True).over(w)), carried, group, ["_c"])
    return filled.withColumn(name, F.coalesce("_own", "_c")).drop("_v", "_own", "_c", "_part")


def _same(group: Sequence[str], prefix: str, part: str) -> Column:
    same = F.col("_part") == F.col(part)
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"{prefix}{i}"))
    return same


def restart_runs_in_parts(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str = "run") -> DataFrame:
    """As :func:`restart_runs` for groups of any size: a part counts its own restarts, its first row looks at the last of the
    part before, and the counts of the parts before are added."""
    d = _in_parts(df, group, order)
    w, restart = Window.partitionBy(*group, "_part").orderBy(*order), lambda prev: F.when(prev.isNull() | F.col(value).isNull() | (F.col(value) <= prev), 1).otherwise(0)
    d = d.withColumn("_first", F.row_number().over(w) == 1).withColumn("_f", F.when(F.col("_first"), 0).otherwise(restart(F.lag(value).over(w))))
    edge = lambda pick: pick(F.struct(*order, F.col(value).alias("_v")))["_v"]
    parts = d.groupBy(*group, "_part").agg(F.sum("_f").alias("_n"), edge(F.min).alias("_from"), edge(F.max).alias("_to"))
    by = Window.partitionBy(*group).orderBy("_part")
    parts = parts.withColumn("_prev", F.lag("_to").over(by)).withColumn("_lead", F.when(F.col("_prev").isNull() | F.col("_from").isNull() | (F.col("_from") <= F.col("_prev")), 1).otherwise(0))
    parts = parts.withColumn("_c", F.sum(F.col("_n") + F.col("_lead")).over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    out = _with_carried(d, _carried(parts.select(*group, "_part", "_c"), group), group, ["_c"])
    run = F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("_c", F.lit(1))
    return out.withColumn(name, run).drop("_f", "_first", "_c", "_part")


def numbered_sort(df: DataFrame, *keys: str, name: str = "place") -> DataFrame:
    """df with every row's zero-based place in the order of the keys, then of all other columns. Ranges sort themselves; a
    row's place is its place in its range plus the sizes of the ranges before, one number each."""
    rest = [c for c in df.columns if c not in keys]
    path = scratch(df.sparkSession, "sorted")
    df.orderBy(*keys, *rest).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    d = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = d.groupBy("_part").agg(F.count("*").alias("n")).select("_part", before.alias("_before"))
    return d.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")


def anchor_slices(df: DataFrame, group: Sequence[str], order: str, is_anchor: Column, text: str) -> DataFrame:
    """(group, anchor, n_lines, content): lines from each anchor up to the next; lines before the first are left out."""
    w = Window.partitionBy(*group).orderBy(order)
    d = df.withColumn("_a", F.sum(is_anchor.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_a > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return d.groupBy(*group, F.col("_a").alias("anchor")).agg(F.count("*").alias("n_lines"), F.array_join(lines, " ").alias("content"))


def _firsts(values: list[float], opens: list[bool], gap: float, span: float, first: float | None = None, last: float | None = None) -> list[float]:
    """The first value of each value's row, in one pass over sorted values: a row ends after a gap, where its span would be
    exceeded, and where ``opens`` says so. ``first`` and ``last`` are those of a row that is open before the values."""
    out = []
    for v, new in zip(values, opens, strict=True):
        if new or first is None or v - last > gap or v - first > span:
            first = v
        out.append(first)
        last = v
    return out


def linkage_rows(values: Column, gap: float, span: float) -> Column:
    """array<struct<v, first, row>> of sorted values: a value joins the current row if it lies within ``gap`` of the one
    before and within ``span`` of the row's first. The span cap makes it no island condition."""

    @F.pandas_udf("first array<double>, row array<int>")
    def rows(series: pd.Series) -> pd.DataFrame:
        out = []
        for v in series:
            if v is None:
                out.append((None, None))
                continue
            firsts = np.array(_firsts(list(v), [False] * len(v), gap, span), dtype=float)
            out.append((firsts, (np.cumsum(np.append(True, firsts[1:] != firsts[:-1])[: len(v)])).astype(np.int32)))
        return pd.DataFrame(out, columns=["first", "row"])

    v = F.sort_array(F.transform(values, lambda v: v.cast("double")))
    at = rows(v)
    return F.zip_with(v, F.arrays_zip(at["first"].alias("first"), at["row"].alias("row")), lambda x, r: F.struct(x.alias("v"), r["first"].alias("first"), r["row"].alias("row")))


def linkage(df: DataFrame, group: str, value: str, gap: float, span: float, name: str = "first") -> DataFrame:
    """df with the first value of each value's row, groups of any size; null values are left out.

    Values are counted into cells as wide as the gap: an empty cell is a gap, so the parts between empty cells do not see
    each other and are dealt over tasks. A task streams its parts in order and keeps one open row."""
    d = df.filter(F.col(value).isNotNull()).withColumn("_cell", F.floor(F.col(value) / gap))
    cells = d.select(group, "_cell").distinct()
    w = Window.partitionBy(group).orderBy("_cell")
    cells = cells.withColumn("_part", F.sum(F.when(F.col("_cell") - F.lag("_cell").over(w) == 1, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.join(cells.select(F.col(group).alias("_g"), "_cell", "_part"), F.col(group).eqNullSafe(F.col("_g")) & (d["_cell"] == cells["_cell"])).select(d["*"], "_part").drop("_cell")
    d = d.withColumn("_v", F.col(value).cast("double")).repartition(group, "_part").sortWithinPartitions(group, "_part", "_v")
    names = [c for c in d.columns if c not in ("_part", "_v")]

    def run(batches):
        key, first, last = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            g, part, v = b.column(group), b.column("_part"), b.column("_v").to_numpy(zero_copy_only=False)
            codes = g.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            p = part.to_numpy(zero_copy_only=False)
            opens = np.append((g[0].as_py(), part[0].as_py()) != key, (codes[1:] != codes[:-1]) | (p[1:] != p[:-1]))
            out = _firsts(v.tolist(), opens.tolist(), gap, span, first, last)
            key, first, last = (g[len(g) - 1].as_py(), part[len(part) - 1].as_py()), out[-1], float(v[-1])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(out, pa.float64())], names=names + [name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name in names)
    return d.mapInArrow(run, f"{schema}, `{name}` double")


def _distributed(lines: Sequence[str]) -> list[str]:
    out: list[str] = []
    head, used = "", True
    for s in lines:
        if s.startswith("- "):
            out.append(f"{head} {s[2:]}" if head else s[2:])
            used = True
            continue
        if not used:
            out.append(head)
        head, used = (s, False) if s.endswith(":") else ("", True)
        if used:
            out.append(s)
    return out if used else [*out, head]


def distribute_headers(statements: Column) -> Column:
    """A bare header (ends in a colon, no bullet) prefixes the bullets after it until a line that is none; alone, it
    becomes a statement itself. Null lines are left out."""

    @F.pandas_udf("array<string>")
    def run(series: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else _distributed([x for x in v if x is not None]) for v in series])

    return run(statements)


def values_at(df: DataFrame, group: str, value: str, places: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """(group, one column per place): exact order statistics. A place maps a group's row count to a zero-based rank.

    Values are numbers; null ones and null groups are left out. Equal values are counted first. Approximate quantiles cut a group's distinct
    values into 256 bins; exact bin sizes tell which bins hold the ranks, and only these are sorted, each by itself. The
    cuts decide the size of the bins alone, never the result."""
    seen = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    cuts = seen.groupBy(group).agg(F.percentile_approx(value, [k / 256 for k in range(1, 256)], 2_000).alias("_cuts"))
    binned = seen.join(cuts, group).select(group, value, "_n", F.size(F.filter("_cuts", lambda c: c < F.col(value))).alias("_bin"))
    sizes = binned.groupBy(group, "_bin").agg(F.sum("_n").alias("_s"))
    end, total = F.sum("_s").over(Window.partitionBy(group).orderBy("_bin")), F.sum("_s").over(Window.partitionBy(group))
    ranks = sizes.select(group, "_bin", (end - F.col("_s")).alias("_before"), end.alias("_end"), *[rank(total).cast("long").alias(f"_at_{name}") for name, rank in places.items()])
    held = F.lit(False)
    for name in places:
        held |= (F.col(f"_at_{name}") >= F.col("_before")) & (F.col(f"_at_{name}") < F.col("_end"))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(group, "_bin").orderBy(value))
    rows = binned.join(ranks.filter(held), [group, "_bin"]).withColumn("_upto", upto)
    pick = lambda name: F.min(F.when((F.col(f"_at_{name}") < F.col("_upto")) & (F.col(f"_at_{name}") >= F.col("_upto") - F.col("_n")), F.col(value)))
    return rows.groupBy(group).agg(*[pick(name).alias(name) for name in places])
