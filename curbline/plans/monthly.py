"""The monthly run: raw feeds to clean, enriched and KPI tables.

Each layer is written once and read back by the next, as separate jobs would:
a lost executor costs a layer's tasks, not the month. Row counts come from
observations made while writing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators.clean import cleanse
from curbline.operators.enrich import enrich, union_evolved
from curbline.operators.kpi import hourly_kpis, with_rolling_week
from curbline.schema import GOLD_FACT, GOLD_KPI, PARTITION_KEYS, RAW_COLUMNS, REQUIRED_RAW, SILVER, assert_schema
from curbline.sources.readers import path_exists, read_feed, read_month
from curbline.sources.sinks import replace_partition

FEEDS = ("yellow", "green")


@dataclass(frozen=True)
class MonthCounts:
    clean: dict[str, int]
    enriched: int
    kpi: int


def kpi_rows(fact: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Hourly KPIs with rolling means, keyed for the month partition."""
    keys = (*PARTITION_KEYS, "pickup_date", "pickup_hour", "pickup_borough")
    return with_rolling_week(hourly_kpis(fact, keys), earlier)


def week_before(spark: SparkSession, path: str, year: int, month: int) -> DataFrame | None:
    """The hourly rows of the seven days ahead of a month, as far as they were computed."""
    first = date(year, month, 1)
    start = first - timedelta(days=7)
    if not path_exists(spark, f"{path}/{PARTITION_KEYS[0]}={start.year}/{PARTITION_KEYS[1]}={start.month}"):
        return None
    return read_month(spark, path, start.year, start.month).where(f"pickup_date >= date '{start}'")


def declared(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The frame with every column of its contract, or an error that names what is missing or of another type.

    Raw columns that a vintage may lack are NULL there; columns that no contract names yet pass.
    """
    have = set(df.columns)
    absent = [f for f in contract.fields if f.name in RAW_COLUMNS and f.name not in (have | REQUIRED_RAW)]
    out = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df
    named = {f.name for f in contract.fields}
    return assert_schema(out, contract, [c for c in out.columns if c not in named])


def run_month(spark: SparkSession, root: str, year: int, month: int, zones: DataFrame,
              carry_week: bool = False) -> MonthCounts:
    """Bring one month through all layers; running it again gives the same tables.

    Rolling means begin anew each month; with ``carry_week`` they also take in
    the hourly rows of the week before, which are few and already aggregated.
    """
    target = dict(zip(PARTITION_KEYS, (year, month), strict=True))
    clean = {
        feed: replace_partition(
            declared(cleanse(read_feed(spark, root, feed, year, month), feed, year, month), SILVER),
            f"{root}/silver/{feed}", target, SILVER,
        )
        for feed in FEEDS
    }
    trips = union_evolved([read_month(spark, f"{root}/silver/{f}", year, month) for f in FEEDS])
    enriched = replace_partition(declared(enrich(trips, zones), GOLD_FACT), f"{root}/gold/fact_trips", target, GOLD_FACT)
    fact = read_month(spark, f"{root}/gold/fact_trips", year, month)
    earlier = week_before(spark, f"{root}/gold/hourly_kpis", year, month) if carry_week else None
    hours = assert_schema(kpi_rows(fact, earlier), GOLD_KPI, PARTITION_KEYS)
    kpi = replace_partition(hours, f"{root}/gold/hourly_kpis", target, GOLD_KPI)
    return MonthCounts(clean, enriched, kpi)
