"""Connected components by contraction, on the cluster: no part of the graph is gathered in one place.

Each round maps every node to the neighbour (or itself) of least hashed priority and rewrites the edges with that map;
edges inside a contracted node go. Hashed priorities keep long chains from shrinking by a node at a time. Minima are
pre-aggregated before the shuffle, so a hub of any degree costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge to another; ``root`` is a node of its component."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    e = materialize(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("p"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("a").alias("p"), F.col("a").alias("n"))
        to = materialize(near.select(F.col("a").alias("node"), F.least(F.col("m"), own)["n"].alias("root")), "contraction")
        maps.append(to)
        one = e.join(to.withColumnRenamed("node", "a").withColumnRenamed("root", "ra"), "a")
        two = one.join(to.withColumnRenamed("node", "b").withColumnRenamed("root", "rb"), "b").filter("ra <> rb")
        e = materialize(two.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for to in maps[1:]:
        step = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return materialize(out, "components")
