"""Joins with fixed tie rules: first or last of equal keys, two-tier keys, patterns, ranges, recurrences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: Sequence[str], order: Column, last: bool = False) -> DataFrame:
    """One row per key, the first (or last) by ``order``. An aggregate with map-side combine, not a window: a hot key
    costs a row per task. ``order`` must be total, or equal rows be alike."""
    rest = [c for c in df.columns if c not in keys]
    pick = (F.max if last else F.min)(F.struct(order.alias("_o"), *rest)).alias("_p")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_p.{c}").alias(c) for c in rest])


def two_tier_join(left: DataFrame, right: DataFrame, tiers: Sequence[Sequence[str]], order: str, take: Sequence[str]) -> DataFrame:
    """Left join on the first tier's keys, else the second's; in each tier the first row by ``order`` wins. A hit whose
    values are null still counts as a hit. Adds ``tier`` (null without a hit) and the taken columns."""
    out, hits = left, []
    for i, keys in enumerate(tiers):
        side = right.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys)).select(*keys, F.col(order).alias("_ord"), *take)
        side = first_of(side, keys, F.col("_ord")).select(*[F.col(k) for k in keys], F.lit(True).alias(f"_hit{i}"), *[F.col(c).alias(f"_t{i}_{c}") for c in take])
        out = out.join(side, list(keys), "left")
        hits.append(F.coalesce(F.col(f"_hit{i}"), F.lit(False)))
    tier, values = F.lit(None).cast("int"), {c: F.lit(None) for c in take}
    for i in range(len(tiers) - 1, -1, -1):
        tier = F.when(hits[i], i + 1).otherwise(tier)
        values = {c: F.when(hits[i], F.col(f"_t{i}_{c}")).otherwise(v) for c, v in values.items()}
    return out.select(*left.columns, tier.alias("tier"), *[v.alias(c) for c, v in values.items()])


def exists_either(left: DataFrame, right: DataFrame, keys: Sequence[Sequence[str]], name: str = "joined") -> DataFrame:
    """left plus whether either key has a partner."""
    out, flags = left, []
    for i, k in enumerate(keys):
        out = out.join(right.select(*k).distinct().withColumn(f"_k{i}", F.lit(True)), list(k), "left")
        flags.append(F.coalesce(F.col(f"_k{i}"), F.lit(False)))
    hit = flags[0]
    for f in flags[1:]:
        hit = hit | f
    return out.select(*left.columns, hit.alias(name))


def ordered_pattern(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Value of the first listed pattern that the text contains, whatever its case: one short-circuit CASE."""
    low, out = F.lower(text), None
    for pattern, value in rules:
        hit = F.contains(low, F.lit(pattern.lower()))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def longest_prefix(text: Column, prefixes: Sequence[str]) -> Column:
    """The longest listed prefix of a text; null without one."""
    out = None
    for p in sorted(prefixes, key=lambda p: (-len(p), p)):
        out = F.when(text.startswith(p), p) if out is None else out.when(text.startswith(p), p)
    return out


def recurrences(df: DataFrame, ident: str, group: str, day: str, closed: str, elements: str, window: int) -> DataFrame:
    """(a, b, group, gap): b follows a in (day, id), within ``window`` days, after a was closed, sharing an element.

    The range condition becomes an equality of day bins of the window's width (each a meets its own bin and the next),
    so a hot group is dealt over its bins instead of meeting itself in one task."""
    width = max(1, window)
    bin_ = F.floor(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) / width)
    a = df.filter(F.col(closed).isNotNull()).select(F.col(ident).alias("a"), F.col(group).alias("_g"), F.col(day).alias("_da"), F.col(closed).alias("_ca"), F.col(elements).alias("_ea"), F.explode(F.array(bin_, bin_ + 1)).alias("_bin"))
    b = df.select(F.col(ident).alias("b"), F.col(group).alias("_g"), F.col(day).alias("_db"), F.col(elements).alias("_eb"), bin_.alias("_bin"))
    on = a.join(b, ["_g", "_bin"]).filter((F.col("_db") > F.col("_ca")) & F.datediff("_db", "_da").between(0, window) & ((F.col("_db") > F.col("_da")) | (F.col("b") > F.col("a"))) & F.arrays_overlap("_ea", "_eb"))
    return on.select("a", "b", F.col("_g").alias(group), F.datediff("_db", "_da").alias("gap"))


def column_difference(declared: Sequence[str], df: DataFrame) -> DataFrame:
    """(column, side): declared but missing, or present but not declared."""
    spark = df.sparkSession
    rows = [(c, "missing") for c in declared if c not in df.columns] + [(c, "orphan") for c in df.columns if c not in set(declared)]
    return spark.createDataFrame(rows, "column string, side string")


def suffix_collisions(df: DataFrame, key: str, suffix: str, ident: str, salts: int = 64) -> DataFrame:
    """df with ``-`` and ``suffix`` appended to every key that more than one row has; a null key stays null.

    Rows are counted by key and salt of the identifier, and totals go back only to the salts that a key has, so a hot key's
    rows are dealt over ``salts`` tasks."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(ident)), F.lit(salts)).cast("int"))
    parts = salted.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
    shared = parts.groupBy(key).agg(F.sum("_n").alias("_all")).filter("_all > 1")
    both = salted.join(parts.select(key, "_salt").join(shared, key), [key, "_salt"], "left")
    named = F.when(F.col("_all").isNotNull(), F.concat_ws("-", F.col(key), F.col(suffix))).otherwise(F.col(key))
    return both.withColumn(key, named).select(*df.columns)


def near_values(values: DataFrame, value: str, count: str, share: float = 0.5) -> DataFrame:
    """(a, b, n) with a < b and the lesser count: one value contains the other, or their words have a Jaccard similarity
    of ``share`` or more. ``values`` holds distinct values; empty and null ones are left out.

    Not all pairs: a contained value meets those that hold its rarest run of three characters (all of it, if shorter), and
    word sets meet by their rarest words, so many that sets of the asked similarity must share one."""
    c = values.filter(F.col(value) != "").select(F.col(value).alias("v"), F.col(count).alias("n"), F.array_distinct(F.split(value, " ")).alias("s"))

    def grams(size: int) -> Column:
        places = F.sequence(F.lit(1), F.length("v") - (size - 1))
        return F.when(F.length("v") >= size, F.array_distinct(F.transform(places, lambda i: F.substring(F.col("v"), i, F.lit(size))))).otherwise(F.array().cast("array<string>"))

    index = c.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.explode(F.concat(grams(1), grams(2), grams(3))).alias("g"))
    own = c.select("v", "n", F.explode(F.when(F.length("v") < 3, F.array("v")).otherwise(grams(3))).alias("g"))
    often = index.groupBy("g").agg(F.count("*").alias("f"))
    probe = own.join(often, "g").groupBy("v", "n").agg(F.min(F.struct("f", "g"))["g"].alias("g"))
    inside = probe.join(index, "g").filter((F.col("v") != F.col("b")) & F.contains("b", "v"))
    found = inside.select(F.least("v", "b").alias("a"), F.greatest("v", "b").alias("b"), F.least("n", "nb").alias("n"))

    words = c.select("v", F.explode("s").alias("w"))
    ranked = words.join(words.groupBy("w").agg(F.count("*").alias("f")), "w").groupBy("v").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("r"))
    size = F.size("r")
    first = ranked.select("v", F.explode(F.slice("r", F.lit(1), (size - F.ceil(size * F.lit(share)) + 1).cast("int"))["w"]).alias("w")).join(c, "v")
    x, y = (first.select("w", F.col("v").alias(p), F.col("n").alias(f"n{p}"), F.col("s").alias(f"s{p}")) for p in "ab")
    alike = F.size(F.array_intersect("sa", "sb")) / F.size(F.array_union("sa", "sb")) >= share
    return found.unionAll(x.join(y, "w").filter((F.col("a") < F.col("b")) & alike).select("a", "b", F.least("na", "nb").alias("n"))).distinct()
