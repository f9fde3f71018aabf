"""Bucketed catalog tables: a large fact and a large dimension that meet without a shuffle.

Both tables are dealt by the same hash of the key when they are written; every later join, reference check or
count per key then reads bucket against bucket. A bucket is one task's work and cannot be split while it is read, so
the share of the largest bucket is measured on writing and kept with the entry. A table with a hot key is opened by
its path instead, without its buckets: the join is then an ordinary shuffle that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.joins import orphans

BUCKET_BYTES = 256 * 1024 * 1024
UNEVEN = 4.0
_PROPERTY = "curbline.largest_bucket"


def bucket_count(total_bytes: int, per_bucket: int = BUCKET_BYTES) -> int:
    """Buckets for a table's size: a power of two, so that larger tables' buckets are multiples of smaller ones'."""
    return 1 << max(0, (max(0, total_bytes - 1) // per_bucket).bit_length())


def largest_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> float:
    """Rows of the fullest bucket over the mean of all; 1.0 for an empty frame. Counts per bucket, at most as many rows."""
    counts = df.groupBy(F.expr(f"pmod(hash({', '.join(f'`{k}`' for k in keys)}), {buckets})").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    top, rows = counts.agg(F.max("n"), F.sum("n")).first()
    return top * buckets / rows if rows else 1.0


def write_bucketed(df: DataFrame, database: str, name: str, path: str, keys: Sequence[str], buckets: int) -> float:
    """Write a frame as a bucketed table and enter it in the catalog; returns the largest bucket over the mean.

    Rows are dealt by key first, so that a bucket is one sorted file instead of one from each task. A NULL
    key is a key like any other. The rows are counted from the written table.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", path).bucketBy(
        buckets, *keys).sortBy(*keys).saveAsTable(f"`{database}`.`{name}`")
    share = largest_bucket(spark.read.schema(df.schema).parquet(path), keys, buckets)
    spark.sql(f"ALTER TABLE `{database}`.`{name}` SET TBLPROPERTIES ('{_PROPERTY}' = '{share:.6f}')")
    return share


def open_bucketed(spark: SparkSession, database: str, name: str, uneven: float = UNEVEN) -> DataFrame:
    """The table by its entry, or by its path where one bucket holds ``uneven`` times the mean or more."""
    full = f"`{database}`.`{name}`"
    share = spark.sql(f"SHOW TBLPROPERTIES {full}").where(F.col("key") == _PROPERTY).first()
    if share is not None and float(share["value"]) >= uneven:
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").first()
        return spark.read.schema(spark.table(full).schema).parquet(place["data_type"])
    return spark.table(full)


def bucket_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Sort-merge join of two large tables; bucket against bucket where both are bucketed by ``on``."""
    return left.join(right.hint("merge"), on, how)


def bucket_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys without a parent and their rows: counted and compared within the buckets."""
    return orphans(child, key, parent.hint("merge"), parent_key)
