"""Event streams: hourly measures that close by watermark, and duplicates dropped across landings.

Hours are kept as state until the watermark (the latest event time less the allowed delay) has passed their end; then they
are final and leave the state. Every micro-batch is one partition of the target table, written by dynamic
partition overwrite, so a batch that is run again after a failure replaces itself. Rows that come after their
hour has closed change nothing; Spark counts what it drops.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions.numeric import ACCUMULATOR
from curbline.sources.sinks import insert_overwrite

BATCH = "landing_batch"


@dataclass(frozen=True)
class StreamCounts:
    batches: int
    rows: int
    #: Late rows as Spark counts them: after each task has folded the rows of an hour.
    dropped: int
    #: Keys still in the state at the end.
    open_keys: int


def hourly_measures(events: DataFrame, ts: str, keys: Sequence[str], value: str, delay: str) -> DataFrame:
    """(hour_start, keys, events, total) of closed hours. ``events`` may stream; rows without a time have no hour."""
    hour = F.window("_at", "1 hour")
    return events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay).groupBy(hour, *keys).agg(
        F.count(F.lit(1)).alias("events"), F.expr(f"sum(try_cast({value} as {ACCUMULATOR}))").alias("total")).select(
        F.col("window.start").alias("hour_start"), *keys, "events", F.col("total").cast("double").alias("total"))


def without_repeats(rows: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    """The first row of each key to land. Keys leave the state once the watermark is ``delay`` past them, so copies
    are found when their times and landings lie within that delay."""
    return rows.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay).dropDuplicatesWithinWatermark(
        list(keys)).drop("_at")


def follow_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """A stream over the Parquet files of a folder and its subfolders, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option(
        "recursiveFileLookup", "true").parquet(path)


def run_into(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> StreamCounts:
    """Process what has landed since the last run into the table at ``path``; batches are its partitions.

    ``state_partitions`` is fixed by the first run of a checkpoint.
    """
    spark = stream.sparkSession
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)

    def each(batch: DataFrame, batch_id: int) -> None:
        insert_overwrite(batch.withColumn(BATCH, F.lit(batch_id)), path, [BATCH], contract=batch.schema)

    if state_partitions:
        spark.conf.set(name, str(state_partitions))
    try:
        query = stream.writeStream.outputMode("append").foreachBatch(each).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    seen = query.recentProgress
    states = [p["stateOperators"][0] for p in seen if p["stateOperators"]]
    return StreamCounts(len(seen), sum(p["numInputRows"] for p in seen),
                        sum(s["numRowsDroppedByWatermark"] for s in states), states[-1]["numRowsTotal"] if states else 0)
