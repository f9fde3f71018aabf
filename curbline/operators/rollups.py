"""Mergeable state per fine key: coarser medians and distinct counts come from it, not from the trips.

A state row holds a count, a KLL sketch of a measure and bitmaps of an identifier. Sketches and bitmaps
of finer keys merge into those of coarser ones. Distinct counts are exact; a median is a value whose rank is off by a
small share of the rows (``RANK_ERROR`` is several times the usual error of a sketch of size ``SKETCH_SIZE``).
A bitmap covers 32,768 identifiers in 4 kB, so wide identifiers take several rows of state per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 400
RANK_ERROR = 0.03


def mergeable_state(df: DataFrame, keys: Sequence[str], measure: str, ident: str) -> DataFrame:
    """keys, bucket (of identifiers), rows, sketch, bitmap. NULL measures and identifiers count as rows only."""
    numbered = df.select(*keys, F.col(measure).cast("double").alias("_measure"), F.col(ident).cast("long").alias("_ident"))
    return numbered.withColumn("bucket", F.expr("bitmap_bucket_number(_ident)")).groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"kll_sketch_agg_double(_measure, {SKETCH_SIZE})").alias("sketch"),
        F.expr("bitmap_construct_agg(bitmap_bit_position(_ident))").alias("bitmap"),
    )


def merge_state(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of coarser keys; it can be merged again."""
    return state.groupBy(*keys, "bucket").agg(
        F.sum("rows").alias("rows"),
        F.expr(f"kll_merge_agg_double(sketch, {SKETCH_SIZE})").alias("sketch"),
        F.expr("bitmap_or_agg(bitmap)").alias("bitmap"),
    )


def roll_up(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, row_count, unique_count, measured (rows with a measure), median (NULL without any)."""
    merged = merge_state(state, keys).withColumn(
        "ids", F.when(F.col("bucket").isNotNull(), F.expr("bitmap_count(bitmap)")).otherwise(0))
    whole = merged.groupBy(*keys).agg(
        F.sum("rows").alias("row_count"), F.sum("ids").alias("unique_count"),
        F.expr(f"kll_merge_agg_double(sketch, {SKETCH_SIZE})").alias("sketch"))
    n = F.expr("kll_sketch_get_n_double(sketch)")
    return whole.select(
        *keys, "row_count", "unique_count", n.alias("measured"),
        F.when(n > 0, F.expr("kll_sketch_get_quantile_double(sketch, 0.5D)")).alias("median"))


def rank_range(df: DataFrame, keys: Sequence[str], measure: str, medians: DataFrame) -> DataFrame:
    """keys, measured, and the shares of measured rows of ``df`` below the median (``below``) and up to it (``upto``).

    ``medians`` has the columns of :func:`roll_up`; groups without a measure are left out.
    """
    own = df.selectExpr(*keys, f"cast({measure} as double) as _measure", "0 as _level").where("_measure is not null")
    other = medians.select(*[F.col(k).alias(f"_{k}") for k in keys], "median", "measured", F.lit(0).alias("_other"))
    same = F.col("_level") == F.col("_other")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return own.join(other, same).groupBy(*keys).agg(
        F.max("measured").alias("measured"),
        (F.count_if(F.expr("_measure < median")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.expr("_measure <= median")) / F.count(F.lit(1))).alias("upto"))
