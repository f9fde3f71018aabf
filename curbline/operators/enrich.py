"""Clean trips to the enriched fact: feed union, dimension joins, features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from curbline.functions import trip as ft
from curbline.operators.joins import dim_join, small_enough
from curbline.sources.readers import payment_types


def union_evolved(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column one frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def zone_role(zones: DataFrame, key: str, prefix: str, service_zone: bool = True) -> DataFrame:
    """The zone table under the names of one role, such as pickup."""
    columns = [
        f"cast(LocationID as bigint) as {key}", f"Borough as {prefix}_borough", f"Zone as {prefix}_zone",
    ]
    if service_zone:
        columns.append(f"service_zone as {prefix}_service_zone")
    return zones.selectExpr(*columns)


def enrich_zones(trips: DataFrame, zones: DataFrame, small: bool | None = None,
                 dropoff: bool = True) -> DataFrame:
    """Pickup and, unless left out, dropoff zone attributes; the zone table is measured once."""
    if small is None:
        small = small_enough(zones)
    placed = dim_join(trips, zone_role(zones, "PULocationID", "pickup"), "PULocationID", small)
    if dropoff:
        role = zone_role(zones, "DOLocationID", "dropoff", service_zone=False)
        placed = dim_join(placed, role, "DOLocationID", small)
    return placed


def enrich_payment(trips: DataFrame) -> DataFrame:
    """Payment type names, from a literal table of six rows."""
    return dim_join(trips, payment_types(trips.sparkSession), "payment_type", small=True)


def derive_gold_features(trips: DataFrame) -> DataFrame:
    return trips.selectExpr(
        "*",
        f"{ft.tip_rate('tip_amount', 'fare_amount')} as tip_rate",
        f"{ft.is_airport_zone('pickup_service_zone')} as is_airport_trip",
        f"{ft.is_weekend_dow('pickup_dow')} as is_weekend",
        f"{ft.time_of_day('pickup_hour')} as time_of_day",
    )


def enrich_for_kpis(trips: DataFrame, zones: DataFrame, small: bool | None = None) -> DataFrame:
    """Only what the hourly KPIs read.

    Spark keeps a left join whose columns nobody uses, since it cannot know
    that the dimension is unique; so the unused joins are not asked for.
    """
    return derive_gold_features(enrich_zones(trips, zones, small, dropoff=False))


def enrich(trips: DataFrame, zones: DataFrame, small: bool | None = None) -> DataFrame:
    """Both zone roles, payment names and derived features."""
    return derive_gold_features(enrich_payment(enrich_zones(trips, zones, small)))
