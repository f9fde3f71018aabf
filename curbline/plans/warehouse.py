"""Marts built from clean feeds, lazily or as tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import marts
from curbline.operators.incremental import LOOKBACK_DAYS, latest_day, lookback, since
from curbline.sources.readers import load_seed
from curbline.sources.sinks import insert_overwrite
from curbline.sources.spines import date_spine


def staged(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """All feeds under the mart names."""
    return marts.union_staged([marts.stage_trips(df, cab) for cab, df in feeds.items()])


def fact(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with its surrogate key."""
    return marts.fact_trips(marts.with_trip_key(staged(feeds)))


def hourly(feeds: Mapping[str, DataFrame], zones: DataFrame, start: date | str, end: date | str,
           small_zones: bool | None = None) -> DataFrame:
    """The hourly mart; the surrogate key plays no part in it and is not computed."""
    spark = zones.sparkSession
    return marts.mart_hourly(
        marts.fact_trips(staged(feeds)), marts.dim_location(load_seed(zones)),
        marts.dim_datetime(date_spine(spark, start, end)), small_zones,
    )


def refresh_fact(feeds: Mapping[str, DataFrame], path: str, as_of: date | str | None = None,
                 days: int = LOOKBACK_DAYS, full: bool = False, contract: T.StructType | None = None) -> None:
    """Write the fact by pickup date: all of it, or the last days.

    The look-back is put on the staged rows, before they are keyed: copies share
    their pickup time, so whole groups are in or out and keys do not change.
    Late rows are picked up because their days are computed again as a whole. Trips are numbered where they
    are dealt to their days; what follows from a trip alone, its key and measures, is worked out behind that shuffle.
    """
    trips = staged(feeds)
    if not full:
        until = as_of or latest_day(trips, "pickup_date")
        if until is None:
            return
        trips = since(trips, "pickup_at", until, days)
    numbered, dealt = marts.numbered_by_day(trips)
    insert_overwrite(numbered, path, ["pickup_date"], contract, dealt=dealt,
                     behind=lambda rows: marts.fact_trips(marts.keyed_trips(rows)))


def refresh_mart(fact_table: DataFrame, zones: DataFrame, path: str, as_of: date | str | None = None,
                 days: int = LOOKBACK_DAYS, full: bool = False, contract: T.StructType | None = None) -> None:
    """Write the hourly mart from the written fact: all of it, or the last days.

    The fact is partitioned by pickup date, so a look-back opens those days only.
    """
    if not full:
        until = as_of or latest_day(fact_table, "pickup_date")
        if until is None:
            return
        fact_table = lookback(fact_table, "pickup_date", until, days)
    first, last = fact_table.agg(F.min("pickup_date"), F.max("pickup_date")).first()
    if first is None:
        return
    model = marts.mart_hourly(
        fact_table, marts.dim_location(load_seed(zones)),
        marts.dim_datetime(date_spine(zones.sparkSession, first, last)),
    )
    insert_overwrite(model, path, ["pickup_date"], contract)
