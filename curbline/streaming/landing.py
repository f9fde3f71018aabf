"""Follow a landing folder: run each month whose files are new.

A file-source stream remembers in its checkpoint which files it has seen, so a
month that has landed is skipped on the next run and a late file brings its
month back. The months themselves are computed by the batch functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of Spark's file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

MonthHandler = Callable[[str, int, int], None]


def months_of(batch: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) folders behind a batch of files; one row per folder reaches the driver."""
    folder = F.regexp_extract("path", r"/(\d{4}-\d{2})/[^/]+$", 1)
    found = batch.select(folder.alias("folder")).where("folder <> ''").distinct().orderBy("folder")
    return [(int(r.folder[:4]), int(r.folder[5:])) for r in found.collect()]


def follow_feed(spark: SparkSession, root: str, feed: str, checkpoint: str, on_month: MonthHandler) -> int:
    """Handle every month with new files, then stop; returns the number handled.

    The stream has one row per file. Its content column is never selected, and
    so the files are not opened here.
    """
    handled: list[tuple[int, int]] = []

    def each(batch: DataFrame, _batch_id: int) -> None:
        for year, month in months_of(batch):
            on_month(feed, year, month)
            handled.append((year, month))

    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.parquet")
        .load(f"{root}/bronze/{feed}/*").select("path")
    )
    stream = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    stream.awaitTermination()
    return len(handled)
