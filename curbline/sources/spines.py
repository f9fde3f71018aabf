"""Generated rows: date spine, expected-month grid, vintage flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Feeds published monthly, and the ones that carry the congestion
# fee from a given month on.
ALL_FEEDS = ("yellow", "green", "fhv", "fhvhv")
CONGESTION_FEE_FEEDS = ("yellow", "green", "fhvhv")
CONGESTION_FEE_FROM = date(2025, 1, 1)


# Months that were never published, per feed.
UNPUBLISHED = {
    "yellow": ["2026-05", "2026-06", "2026-07", "2026-08", "2026-09", "2026-10", "2026-11", "2026-12"],
    "green": ["2026-05", "2026-06", "2026-07", "2026-08", "2026-09", "2026-10", "2026-11", "2026-12"],
    "fhvhv": ["2026-02", "2026-03", "2026-04", "2026-05", "2026-06", "2026-07", "2026-08", "2026-09",
              "2026-10", "2026-11", "2026-12"],
    "fhv": ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05", "2026-06", "2026-07", "2026-08",
            "2026-09", "2026-10", "2026-11", "2026-12"],
}


def unpublished_months(months: Mapping[str, Sequence[str]] = UNPUBLISHED) -> list[tuple[str, date]]:
    """(feed, first day) of every month that is never looked for."""
    return [(feed, date.fromisoformat(f"{m}-01")) for feed, found in months.items() for m in found]


def date_spine(spark: SparkSession, start: date | str, end: date | str,
               name: str = "date_day") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(
        F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), F.expr("interval 1 day")
    )
    return spark.range(1).select(F.explode(days).alias(name))


def expected_partitions(
    spark: SparkSession, feeds: Sequence[str], start: date | str, end: date | str,
) -> DataFrame:
    """Every (feed, month_start) from the month of ``start`` to that of ``end``."""
    months = F.sequence(
        F.trunc(F.lit(str(start)).cast("date"), "month"),
        F.trunc(F.lit(str(end)).cast("date"), "month"),
        F.expr("interval 1 month"),
    )
    return (
        spark.range(1)
        .select(F.explode(months).alias("month_start"))
        .select(F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"), "month_start")
    )


def has_column_since(feed: str, month: str, since: Mapping[str, date] | None = None) -> Column:
    """Whether (feed, month) carries a column that some feeds gained at a known month."""
    rule = since or dict.fromkeys(CONGESTION_FEE_FEEDS, CONGESTION_FEE_FROM)
    out = F.lit(False)
    for name, first in rule.items():
        out = out | ((F.col(feed) == name) & (F.col(month) >= F.lit(first)))
    return out
