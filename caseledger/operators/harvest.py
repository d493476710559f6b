"""Walks over pages: a paginated listing that stops when it brings nothing new, and what links lead to round by round."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.sources.files import scratch


def walk_listing(entries: DataFrame, site: str, page: str, detail: str, cap: int = 20) -> DataFrame:
    """(site, detail, page): what a reader of each site's numbered pages collects, who starts at 0, turns at most ``cap``
    pages and stops at the first that lists nothing new (or is not there). Each detail comes with the page that listed it first.

    A page is fresh if it is the first to list something; the reader gets as far as the fresh pages run on without a gap, so
    nothing is read page by page."""
    firsts = entries.filter(F.col(detail).isNotNull() & F.col(page).between(0, cap - 1)).groupBy(site, detail).agg(F.min(page).alias(page))
    fresh = firsts.select(site, page).distinct().withColumn("_k", F.row_number().over(Window.partitionBy(site).orderBy(page)) - 1)
    return firsts.join(fresh.filter(F.col("_k") == F.col(page)).drop("_k"), [site, page]).select(site, detail, page)


def follow(seeds: DataFrame, links: DataFrame, source: str, target: str, rounds: int = 20) -> DataFrame:
    """(node, round): what ``links`` lead to from ``seeds`` (a column ``node``), with the round that reached it first.

    Each round joins only what the round before found, drops what is known, and writes the rest to the shared folder, so a
    lost executor costs one round; it ends where a round finds nothing, or after ``rounds``."""
    spark = seeds.sparkSession

    def cut(df: DataFrame) -> DataFrame:
        path = scratch(spark, "follow")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    edges = links.select(F.col(source).alias("node"), F.col(target).alias("_to")).filter("node is not null and _to is not null").distinct()
    frontier = cut(seeds.select("node").filter("node is not null").distinct())
    known = frontier.withColumn("round", F.lit(0))
    for k in range(1, rounds + 1):
        frontier = cut(edges.join(frontier, "node").select(F.col("_to").alias("node")).distinct().join(known.select("node"), "node", "left_anti"))
        if frontier.isEmpty():
            break
        known = known.unionByName(frontier.withColumn("round", F.lit(k)))
    return known


def plan_fetch(wanted: DataFrame, held: DataFrame, key: str, urls: Sequence[str]) -> DataFrame:
    """(key, url, action): what a download has to do. wanted: key, its possible urls and ``sha`` as last seen on the site;
    held: key, ``held_sha``, the last manifest row of each key. The first url that is not blank counts; without one nothing can
    be fetched; an equal digest is skipped, another one is a mismatch to report, and without a held one it is fetched."""
    url = F.coalesce(*[F.nullif(F.trim(F.col(u)), F.lit("")) for u in urls])
    d = wanted.join(held.select(key, "held_sha"), key, "left")
    action = F.when(url.isNull(), "no_url").when(F.col("held_sha").isNull(), "fetch").when(F.col("held_sha") == F.col("sha"), "skip").otherwise("mismatch")
    return d.select(key, url.alias("url"), action.alias("action"))
