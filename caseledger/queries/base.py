"""Registration of queries and the SQL fragments that their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of (spark, table loader); ``sql`` is its DuckDB oracle."""

    def add(f):
        name = f.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda t: table(spark, sf_dir, t))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def sql_mod(key: str, n: int) -> str:
    """sha256(key) as a 256-bit integer modulo n."""
    words = f"list_transform(range(0, 8), lambda word_: ('0x' || substr(sha256({key}), 8 * word_ + 1, 8))::BIGINT::HUGEINT)"
    return f"list_reduce({words}, lambda a, b: (a * 4294967296 + b) % {n}, 0::HUGEINT)::BIGINT"


def sql_hit(rate: float, key: str) -> str:
    return f"({sql_mod(key, 1_000_000)} < {round(rate * 1_000_000)})"


def sql_pick(weights: dict[str, int], key: str, by_key: bool = False) -> str:
    items, upto, out = (sorted(weights.items()) if by_key else list(weights.items())), 0, "CASE"
    for k, w in items:
        upto += w
        out += f" WHEN {sql_mod(key, sum(weights.values()))} < {upto} THEN '{k}'"
    return out + " END"
