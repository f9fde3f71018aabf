"""Look-back windows, landing coverage and work lists."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS = 3


def latest_day(df: DataFrame, day: str) -> date | None:
    """The last date present; runs one job that reads that column."""
    return df.agg(F.max(F.to_date(day))).first()[0]


def lookback(df: DataFrame, day: str, as_of: date | str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows dated ``as_of - days`` or later, so that late rows are picked up again.

    ``as_of`` is a parameter, not the wall clock: months are published after
    they end, and a clock-based window would select nothing.
    """
    if df.schema[day].dataType.simpleString() == "date":
        bound = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    else:
        bound = F.date_sub(F.lit(str(as_of)).cast("date"), days).cast(df.schema[day].dataType)
    return df.where(F.col(day) >= bound)


def since(df: DataFrame, clock: str, as_of: date | str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The same look-back as a bound on a clock column, which a Parquet scan can use."""
    first = date.fromisoformat(str(as_of)) - timedelta(days=days)
    return df.where(F.col(clock) >= F.expr(f"timestamp_ntz '{first} 00:00:00'"))


def scope(df: DataFrame, predicate: str) -> DataFrame:
    """Limit a reprocessing run to the rows of a SQL predicate."""
    return df.where(F.expr(predicate))


def landed_months(df: DataFrame, feed: str, ts: str) -> DataFrame:
    """(feed, month_start) pairs present in a table."""
    return df.select(
        F.col(feed).alias("feed"), F.to_date(F.trunc(F.to_date(ts), "month")).alias("month_start")
    ).where(F.col("month_start").isNotNull()).distinct()


def coverage(expected: DataFrame, landed: DataFrame, unavailable: DataFrame) -> DataFrame:
    """Status of every expected (feed, month): unavailable, exists or missing.

    The order of the tests matters: an unpublished month is never looked for.
    """
    keys = ["feed", "month_start"]
    gone = unavailable.select(*keys).distinct().withColumn("_gone", F.lit(True))
    here = landed.select(*keys).distinct().withColumn("_here", F.lit(True))
    return (
        expected.join(gone, keys, "left").join(here, keys, "left")
        .select(
            *keys,
            F.when(F.col("_gone"), "unavailable").when(F.col("_here"), "exists")
            .otherwise("missing").alias("status"),
        )
    )


def work_list(expected: DataFrame, landed: DataFrame, unavailable: DataFrame) -> DataFrame:
    """Expected months still to be fetched."""
    keys = ["feed", "month_start"]
    return expected.join(unavailable, keys, "left_anti").join(landed, keys, "left_anti")
