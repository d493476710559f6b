"""Event-time counts over a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.sources.files import scratch


def tumbling_counts(spark: SparkSession, source: DataFrame, ts: str, key: str, width: str, late: str) -> DataFrame:
    """Counts by (key, window start), from a stream over the table's files up to what is there now.

    The watermark bounds the state; complete windows are written with a checkpoint in the shared folder, so a restarted
    query goes on where it was. Returns the counts as a table."""
    at = scratch(spark, "stream")
    source.select(ts, key).write.parquet(f"{at}/in")
    stream = spark.readStream.schema(source.select(ts, key).schema).parquet(f"{at}/in").withColumn(ts, F.col(ts).cast("timestamp"))
    agg = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("n"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.select(key, F.col("w.start").alias("day"), "n", F.lit(number).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    q = agg.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{at}/state").queryName(f"counts-{uuid.uuid4().hex[:8]}").trigger(availableNow=True).start()
    q.awaitTermination()
    updates = spark.read.parquet(f"{at}/out/batch=*")
    return updates.groupBy(key, "day").agg(F.max_by("n", "batch").alias("n"))
