"""Running number inside a group, whatever the size of the group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import scratch_path

# Rows per slice of the sorted table; one task numbers one slice of a group.
SLICE_ROWS = 1_000_000
# Groups are counted together by the hash of their keys; what is counted per task is this small table.
BUCKETS = 65_536


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    both = F.lit(True)
    for k in keys:
        both = both & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return both


def add_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordinal",
                slices: int | None = None) -> DataFrame:
    """Number the rows of each group 1..n (a long) by ``order``, then by the other columns.

    No row is dropped and no large group meets in one task. Rows are first counted per bucket of the keys'
    hash. A bucket of at most ``SLICE_ROWS`` rows holds no larger group: its rows are numbered by one window, which
    costs one shuffle. The rows of the other buckets, of which there are fewer than one per ``SLICE_ROWS`` rows, are
    numbered by slices.
    ``slices`` sets a number of slices for all rows instead.
    """
    if slices is not None:
        return _by_slices(df, keys, order, name, slices)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    crowded = {r["bucket"]: r["n"] for r in df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > SLICE_ROWS).collect()}
    if not crowded:
        return _by_group(df, keys, order, name)
    among = bucket.isin(list(crowded))
    slices = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(sum(crowded.values()) / SLICE_ROWS))
    return _by_group(df.where(~among), keys, order, name).unionByName(
        _by_slices(df.where(among), keys, order, name, slices))


def add_ordinal_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                   by: Sequence[str]) -> tuple[DataFrame, bool]:
    """The same number, and whether rows are dealt by ``by``, columns that follow from the keys.

    They are while no value of ``by`` holds more than ``SLICE_ROWS`` rows; a write into directories of ``by``
    then needs no shuffle of its own.
    """
    per_value = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    if (per_value.agg(F.max("n")).first()[0] or 0) > SLICE_ROWS:
        return add_ordinal(df, keys, order, name), False
    return _by_group(df.repartition(*by), [*by, *keys], order, name), True


def _by_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.select("*", number.cast("long").alias(name))


def _by_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int) -> DataFrame:
    """The rows are sorted by range into slices, which cut a large group wherever its order asks for it;
    rows are numbered per group and slice, and a group that lies in several slices is shifted by the counts of the
    earlier ones. Equal rows are told apart by a task number and a count within that task, so that copies can be
    cut as well. Builds one table in the shared scratch folder: both later steps must see the same cuts.
    """
    spark, columns = df.sparkSession, df.columns
    rest = [c for c in columns if c not in keys and c not in order]
    # Folding within a task gives every copy a number that a repeated task gives again.
    counted = df.withColumn("_task", F.spark_partition_id()).groupBy(*columns, "_task").agg(
        F.count(F.lit(1)).alias("_copies"))
    single = counted.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)"))).drop("_copies")
    total_order = [*order, *rest, "_task", "_copy"]
    path = scratch_path(spark, "slices")
    single.repartitionByRange(slices, *keys, *total_order).withColumn(
        "_slice", F.spark_partition_id()).write.parquet(path)
    cut = spark.read.parquet(path)
    local = cut.withColumn("_number", F.row_number().over(
        Window.partitionBy(*keys, "_slice").orderBy(*total_order)).cast("long"))
    shifts = F.broadcast(_shifts(cut, keys)).alias("s")
    shifted = local.alias("t").join(
        shifts, _same_key("t", "s", keys) & (F.col("t._slice") == F.col("s._slice")), "left")
    return shifted.select(*[F.col(f"t.{c}") for c in columns],
                          (F.col("_number") + F.coalesce(F.col("_before"), F.lit(0))).alias(name))


def _shifts(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, slice, rows before) for groups that lie in several slices.

    Such a group holds the first or the last row of a slice, so there are at most
    two rows here per slice, which is two for a million rows of data.
    """
    group = F.struct(*keys)
    ends = cut.groupBy("_slice").agg(F.min(group).alias("low"), F.max(group).alias("high"))
    border = ends.select("_slice", F.explode(F.array("low", "high")).alias("k")).distinct()
    split = border.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k.*")
    inside = cut.alias("c").join(F.broadcast(split.alias("b")), _same_key("c", "b", keys), "left_semi")
    sizes = inside.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
