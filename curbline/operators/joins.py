"""Dimension joins that broadcast only what has been measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side is held in memory by the driver and by every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's values, by one aggregate job over it."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = _FIXED_WIDTH * len(df.columns)
    row = F.lit(fixed)
    for name in texts:
        row = row + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("n")).first()["n"]


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a frame may be broadcast. Runs one job over the frame."""
    return measured_bytes(df) <= limit


def dim_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, small: bool | None = None,
             how: str = "left") -> DataFrame:
    """Left join to a dimension that is unique on its key; fact rows are kept.

    A measured-small dimension is broadcast. A larger one is joined by shuffle,
    where adaptive execution splits a fact key that holds many rows.
    """
    if small is None:
        small = small_enough(dim)
    return fact.join(F.broadcast(dim) if small else dim, on=on, how=how)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, and how many rows carry each.

    Rows are counted per key before the join, so a frequent key crosses the
    shuffle as one row per task. NULL keys are no violation.
    """
    counted = (
        child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(parent_key).alias(key))
    return counted.join(known, on=key, how="left_anti")


def on_days(fact: DataFrame, days: DataFrame, condition: str, day: str = "pickup_date") -> DataFrame:
    """Rows of a day-partitioned fact whose day meets a condition on the calendar's attributes.

    The chosen days are broadcast (one row per calendar day at most). The scan prunes its partitions by
    them while the query runs, so that only the files of those days are opened. Spark does so for a side whose
    filter it takes to be selective, which holds for comparisons and not for flags: a bound that every day
    meets stands beside the condition.
    """
    chosen = days.where(f"({condition}) and date_day >= date '0001-01-01'").select(F.col("date_day").alias(day))
    return fact.join(F.broadcast(chosen), day, "left_semi")
