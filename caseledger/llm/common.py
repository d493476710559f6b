"""What the operators of this subpackage share: table access, materialised cuts of lineage, words and shingles.

Cuts of lineage are Parquet tables below the folder that the session names in ``spark.checkpoint.dir``, which every
executor can read, so a lost executor never costs an operator its intermediate results.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch between the JVM and Python: whole texts are long, and a batch stands in both at once.
BATCH_ROWS = 500
#: Bits of the largest key filter, 8 MB: the proven bound of what is broadcast.
FILTER_BITS = 1 << 26
#: Words of a shingle and the least similarity of near-duplicate and containment operators.
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read by Spark itself so that any store it can open will do."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="caseledger-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write once to the shared folder and read back: a stable, recoverable cut of the lineage."""
    path = shared_path(df.sparkSession, label)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let Python workers see ``BATCH_ROWS`` texts at a time, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_HELD: list[tuple[object, object]] = []


def worker_state(key: object, make: Callable[[], object]) -> object:
    """The one long-lived object of a Python worker (a model with its caches, a vocabulary).

    Workers outlive tasks and operators; when another key asks, what was held is let go, so that a worker never carries
    the caches of two operators. Keys are compared by identity (broadcasts) or equality (paths).
    """
    for held, state in _HELD:
        if held is key or isinstance(key, str) and held == key:
            return state
    release_worker()
    _HELD[:] = [(key, make())]
    return _HELD[0][1]


def release_worker() -> None:
    """Let go of what an earlier operator left in this worker and hand the memory back to the system."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


class KeyFilter:
    """A Bloom filter of 64-bit hashes, of bounded size: no key is missed; others pass rarely, more often where it is full."""

    def __init__(self, words: np.ndarray):
        self.words, self.last = words, np.uint64(len(words) * 64 - 1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        k = keys.view(np.uint64)
        out = np.ones(len(k), dtype=bool)
        for p in (k & self.last, (k >> np.uint64(32)) & self.last):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """A filter of a column of 64-bit hashes: 16 bits a key and at most ``FILTER_BITS``; set bits are counted on the cluster."""
    bits = min(FILTER_BITS, max(1 << 12, 1 << int(16 * keys.count()).bit_length()))
    last = F.lit(bits - 1).cast("long")
    k = F.col(column)
    places = keys.select(F.explode(F.array(k.bitwiseAND(last), F.shiftrightunsigned(k, 32).bitwiseAND(last))).alias("p"))
    rows = places.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("b")).toArrow()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return KeyFilter(words)


def norm_words(column: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array where there are none."""
    return F.filter(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Names that no column of df has, for helpers beside columns of any name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for b in bases:
        while b.lower() in taken:
            b += "_"
        taken.add(b.lower())
        out.append(b)
    return out
