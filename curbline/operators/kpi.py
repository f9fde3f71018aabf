"""Hourly KPIs per borough, rolling means over a time range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.numeric import exact_avg, exact_sum, ratio_if_positive
from curbline.functions.trip import hour_timestamp

HOUR_KEYS = ("pickup_date", "pickup_hour", "pickup_borough")
SEVEN_DAYS = 7 * 24 * 3600


def hourly_kpis(trips: DataFrame, keys: Sequence[str] = HOUR_KEYS) -> DataFrame:
    """Counts, sums, means and distinct zones per key.

    Tasks aggregate before the shuffle, the distinct count included: a busy
    hour costs its reducer one row per task and zone, not one per trip.
    """
    measures = {
        "trip_count": "count(1)",
        "total_revenue": exact_sum("total_amount"),
        "avg_fare": exact_avg("fare_amount"),
        "avg_distance_mi": exact_avg("trip_distance"),
        "avg_duration_min": exact_avg("trip_duration_min"),
        "avg_tip_rate": exact_avg("tip_rate"),
        "airport_trips": "sum(cast(is_airport_trip as bigint))",
        "weekend_trips": "sum(cast(is_weekend as bigint))",
        "unique_pickup_zones": "count(distinct PULocationID)",
    }
    return trips.groupBy(*keys).agg(*[F.expr(f"{sql} as {name}") for name, sql in measures.items()])


def rolling_mean(df: DataFrame, by: Sequence[str], ts: str, measures: Mapping[str, str],
                 seconds: int = SEVEN_DAYS) -> DataFrame:
    """Means over the rows of the last ``seconds``, both ends included.

    Only rows that exist count; gaps are not filled with zeros. Feed it
    aggregates: a group then has at most one row per hour of history, whatever
    the number of trips. ``measures`` maps new names to the columns averaged.
    """
    window = (f"partition by {', '.join(by)} order by unix_timestamp({ts}) "
              f"range between {seconds} preceding and current row")
    kinds = dict(df.dtypes)

    def mean(name: str) -> str:
        if kinds[name] in ("bigint", "int"):
            return f"avg({name}) over ({window})"
        return exact_avg(name, over=window)

    return df.selectExpr("*", *[f"{mean(old)} as {new}" for new, old in measures.items()])


def with_rolling_week(hourly: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Hour timestamp, seven-day means per borough and revenue per mile.

    ``earlier`` holds hourly rows from before: they enter the means and are not
    returned. Without it the first week's windows begin with the first row.
    """
    rows = hourly
    if earlier is not None:
        rows = hourly.selectExpr("*", "true as _wanted").unionByName(
            earlier.select(*hourly.columns).selectExpr("*", "false as _wanted")
        )
    stamped = rows.selectExpr(
        "*",
        f"{hour_timestamp('pickup_date', 'pickup_hour')} as pickup_datetime_hour",
        f"{ratio_if_positive('avg_fare', 'avg_distance_mi')} as revenue_per_mile",
    )
    rolled = rolling_mean(
        stamped, ["pickup_borough"], "pickup_datetime_hour",
        {"rolling_7d_trips": "trip_count", "rolling_7d_revenue": "total_revenue"},
    )
    return rolled if earlier is None else rolled.where("_wanted").drop("_wanted")
