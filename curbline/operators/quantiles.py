"""Exact quantiles of continuous values by refining histograms over value ranges.

Each pass counts, for each open quantile, the values of its range in equal buckets, and keeps the bucket in which the
wanted rank lies, cut to the values it holds. Tasks count before the shuffle, so a pass sends a few hundred rows a group and
task, whatever the size of a group and however many distinct values it has; no window sees the values. Lowest and
highest value of a range never share a bucket, so every pass narrows it, usually by the number of buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.operators.joins import small_enough
from curbline.session import scratch_path

BUCKETS = 512


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "ranges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refined(df: DataFrame, ranges: DataFrame, by: Sequence[str], value: str, buckets: int) -> DataFrame:
    """One pass: ``ranges`` (by, quantile, low, high, rank) cut to the bucket with the rank."""
    small = small_enough(ranges)
    asked = ranges.select(*[F.col(k).alias(f"_{k}") for k in by], "quantile", "low", "high", "rank")
    same = F.col(value).between(F.col("low"), F.col("high"))
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = df.select(*by, value).join(F.broadcast(asked) if small else asked, same)
    # Halves keep the width of a range finite.
    share = F.expr(f"({value} / 2 - low / 2) / nullif(high / 2 - low / 2, 0D)")
    bucket = F.when(F.col(value) == F.col("low"), 0).when(F.col(value) == F.col("high"), buckets - 1).otherwise(
        F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1)))
    counted = inside.groupBy(*by, "quantile", "rank", bucket.cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    # At most ``buckets`` rows of a group and quantile.
    upto = Window.partitionBy(*by, "quantile").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("upto", F.sum("n").over(upto)).where(
        (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).select(
        *by, "quantile", "low", "high", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float],
                    buckets: int = BUCKETS) -> DataFrame:
    """Per group, the sorted value at index floor(n * q), the last one at most, as doubles.

    NULL, NaN and infinite values do not count; a group without any other is left out. Runs a few passes over ``df``.
    """
    finite = df.select(*by, F.col(value).cast("double").alias(value)).where(f"abs({value}) < double('Infinity')")
    ends = finite.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    wanted = F.array(*(F.struct(F.lit(name).alias("quantile"), F.lit(float(q)).alias("q")) for name, q in quantiles.items()))
    ranges = ends.where("n > 0").withColumn("of", F.explode(wanted)).select(
        *by, "of.quantile", "low", "high", F.least(F.floor(F.col("n") * F.col("of.q")), F.col("n") - 1).alias("rank"))
    ranges = _kept(ranges)
    settled = ranges.where("low = high")
    open_ = ranges.where("low < high")
    while not open_.isEmpty():
        ranges = _kept(refined(finite, open_, by, value, buckets))
        settled = settled.unionByName(ranges.where("low = high"))
        open_ = ranges.where("low < high")
    return settled.groupBy(*by).agg(*(
        F.max(F.when(F.col("quantile") == name, F.col("low"))).alias(name) for name in quantiles))
