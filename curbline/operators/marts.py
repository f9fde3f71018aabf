"""Star schema: staging, keyed union, fact, dimensions, hourly mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import calendar as cal
from curbline.functions import trip as ft
from curbline.functions.numeric import exact_avg, exact_sum, round_to
from curbline.operators.joins import dim_join
from curbline.operators.ordinal import add_ordinal, add_ordinal_by
from curbline.sources.readers import payment_types, rate_codes

NATURAL_KEY = ("pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id", "fare_amount",
               "cab_type")

# Boroughs by group; any other borough is OTHER_GROUP.
BOROUGH_GROUPS: dict[str, str] = {
    "Manhattan": "Manhattan",
    "Brooklyn": "Outer boroughs",
    "Queens": "Outer boroughs",
    "Bronx": "Outer boroughs",
    "Staten Island": "Outer boroughs",
}
OTHER_GROUP = "Unknown / EWR"
# Zone names that mark an airport.
AIRPORT_NAMES = ("jfk", "laguardia", "newark")

# Staged name -> (raw name, type).
_STAGED: dict[str, tuple[str, str]] = {
    "vendor_id": ("VendorID", "int"),
    "rate_code_id": ("RatecodeID", "int"),
    "pickup_location_id": ("PULocationID", "int"),
    "dropoff_location_id": ("DOLocationID", "int"),
    "payment_type_id": ("payment_type", "int"),
    "store_and_fwd_flag": ("store_and_fwd_flag", "string"),
    "passenger_count": ("passenger_count", "int"),
    "trip_distance_miles": ("trip_distance", "double"),
    "fare_amount": ("fare_amount", "double"),
    "extra": ("extra", "double"),
    "mta_tax": ("mta_tax", "double"),
    "tip_amount": ("tip_amount", "double"),
    "tolls_amount": ("tolls_amount", "double"),
    "improvement_surcharge": ("improvement_surcharge", "double"),
    "total_amount": ("total_amount", "double"),
    "congestion_surcharge": ("congestion_surcharge", "double"),
    "airport_fee": ("airport_fee", "double"),
}


def staging_gate(trips: DataFrame) -> DataFrame:
    """Both clocks present and in order, total not negative."""
    return trips.where(
        "pickup_datetime is not null and dropoff_datetime is not null "
        "and pickup_datetime < dropoff_datetime and total_amount >= 0"
    )


def stage_trips(trips: DataFrame, cab_type: str) -> DataFrame:
    """One feed's clean trips under the mart names and types.

    A measure the feed does not carry is NULL, so that all feeds line up.
    """
    have = set(trips.columns)
    return staging_gate(trips).selectExpr(
        *[f"cast({raw if raw in have else 'null'} as {kind}) as {name}"
          for name, (raw, kind) in _STAGED.items()],
        "pickup_datetime as pickup_at",
        "dropoff_datetime as dropoff_at",
        "to_date(pickup_datetime) as pickup_date",
        "hour(pickup_datetime) as pickup_hour",
        f"{ft.seconds_between('pickup_datetime', 'dropoff_datetime')} as trip_duration_seconds",
        f"'{cab_type}' as cab_type",
    )


def union_staged(frames: Sequence[DataFrame]) -> DataFrame:
    """All staged feeds; they share one column list."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


COPY_ORDER = ("total_amount", "tip_amount")


def numbered_by_day(trips: DataFrame) -> tuple[DataFrame, bool]:
    """Trips with a running number among the copies of their natural key, and whether they are dealt by day."""
    return add_ordinal_by(trips, NATURAL_KEY, COPY_ORDER, "_ordinal", ["pickup_date"])


def keyed_trips(numbered: DataFrame) -> DataFrame:
    """Numbered trips with their surrogate key in place of the number."""
    kept = [c for c in numbered.columns if c != "_ordinal"]
    return numbered.selectExpr(*kept, f"{ft.natural_key_hash(NATURAL_KEY, '_ordinal')} as trip_id")


def with_trip_key(trips: DataFrame) -> DataFrame:
    """Surrogate key over the natural key and a running number among its copies.

    Copies keep their rows; the number only tells their keys apart.
    """
    return keyed_trips(add_ordinal(trips, NATURAL_KEY, COPY_ORDER, "_ordinal"))


def fact_trips(trips: DataFrame) -> DataFrame:
    """Descriptors from the literal tables and the derived measures."""
    spark = trips.sparkSession
    described = dim_join(
        dim_join(trips, payment_types(spark, "payment_type_id", "payment_type_desc"),
                 "payment_type_id", small=True),
        rate_codes(spark), "rate_code_id", small=True,
    )
    coded = ("payment_type_id", "payment_type_desc", "rate_code_id", "rate_code_desc")
    speed = "try_divide(trip_distance_miles, trip_duration_seconds / 3600D)"
    return described.selectExpr(
        *[c for c in described.columns if c not in coded],
        "coalesce(payment_type_desc, 'Unknown') as payment_type",
        "coalesce(rate_code_desc, 'Unknown') as rate_code",
        f"{round_to(speed, 2)} as avg_speed_mph",
        f"{ft.tip_percent('tip_amount', 'fare_amount')} as tip_pct",
        "case when trip_distance_miles > 0 then "
        f"{round_to('(total_amount / trip_distance_miles)', 2)} end as revenue_per_mile",
    )


def borough_group(borough: str, groups: Mapping[str, str] = BOROUGH_GROUPS) -> str:
    tests = " ".join(f"when '{name}' then '{label}'" for name, label in groups.items())
    return f"case {borough} {tests} else '{OTHER_GROUP}' end"


def dim_location(seed: DataFrame, groups: Mapping[str, str] = BOROUGH_GROUPS) -> DataFrame:
    """Zones with borough group, airport flag and business-district flag."""
    airport = " or ".join(f"contains(lower(zone_name), '{word}')" for word in AIRPORT_NAMES)
    return seed.selectExpr(
        "location_id", "zone_name", "borough", "service_zone",
        f"{borough_group('borough', groups)} as borough_group",
        f"coalesce({airport}, false) as is_airport",
        "coalesce(borough = 'Manhattan' and service_zone = 'Yellow Zone', false) as is_manhattan_cbd",
    )


def dim_datetime(spine: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes per day, in date order."""
    return spine.selectExpr(day, *cal.calendar_columns(day)).orderBy(day)


MART_KEYS = ("pickup_date", "pickup_hour", "cab_type", "borough_group", "is_airport",
             "is_manhattan_cbd")
CALENDAR_ATTRIBUTES = ("is_weekend", "is_us_holiday", "day_name", "month_name", "year_month",
                       "year_quarter")


def mart_hourly(fact: DataFrame, locations: DataFrame, days: DataFrame,
                small_locations: bool | None = None) -> DataFrame:
    """Hourly mart per feed and location group.

    The calendar attributes depend on the date alone, so they are joined to the
    aggregated rows instead of to every trip, and stay out of the group key.
    """
    placed = dim_join(
        fact,
        locations.selectExpr("location_id as pickup_location_id", "borough_group", "is_airport",
                             "is_manhattan_cbd"),
        "pickup_location_id", small_locations,
    )
    measures = {
        "trip_count": "count(1)",
        "total_passengers": "sum(cast(passenger_count as bigint))",
        "total_distance_miles": exact_sum("trip_distance_miles"),
        "avg_distance_miles": exact_avg("trip_distance_miles"),
        "avg_duration_minutes": f"({exact_avg('trip_duration_seconds')}) / 60D",
        "median_duration_minutes": "approx_percentile(trip_duration_seconds, 0.5D) / 60D",
        "avg_speed_mph": exact_avg("avg_speed_mph"),
        "total_fare": exact_sum("fare_amount"),
        "total_tips": exact_sum("tip_amount"),
        "total_revenue": exact_sum("total_amount"),
        "avg_revenue_per_trip": exact_avg("total_amount"),
        "avg_tip_pct": exact_avg("tip_pct"),
        "total_congestion_surcharge": exact_sum("congestion_surcharge"),
        "total_airport_fee": exact_sum("airport_fee"),
        "credit_card_trips": "count_if(payment_type = 'Credit card')",
        "cash_trips": "count_if(payment_type = 'Cash')",
        "revenue_per_trip": f"({exact_sum('total_amount')}) / count(1)",
    }
    whole = ("trip_count", "total_passengers", "credit_card_trips", "cash_trips")
    grouped = placed.groupBy(*MART_KEYS).agg(*[F.expr(f"{sql} as {name}") for name, sql in measures.items()])
    rounded = grouped.selectExpr(*MART_KEYS, *[
        name if name in whole
        else f"{round_to(name, 3 if name == 'avg_distance_miles' else 2)} as {name}"
        for name in measures
    ])
    # One row per calendar day, whatever the number of trips.
    calendar = days.selectExpr("date_day as pickup_date", *CALENDAR_ATTRIBUTES)
    return dim_join(rounded, calendar, "pickup_date", small=True)
