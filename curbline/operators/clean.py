"""Raw feed to clean trips: names, types, gates, derived features, deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions import trip as ft
from curbline.schema import FEED_RENAMES, STABLE_TYPES, VINTAGE_ALIASES

# The quality and sanity limits.
MAX_DISTANCE = 200
MAX_TOTAL = 5000
MIN_PASSENGERS, MAX_PASSENGERS = 1, 6
MIN_MINUTES, MAX_MINUTES = 1, 300
MAX_SPEED = 120

TRIP_ID_FIELDS = ("VendorID", "pickup_datetime", "PULocationID", "DOLocationID")


def normalize_columns(df: DataFrame, feed: str,
                      aliases: Mapping[str, str] = VINTAGE_ALIASES) -> DataFrame:
    """Canonical names for a feed's columns.

    Names are compared exactly as spelled: Spark itself ignores case, so an
    alias that differs only in case is applied only where the canonical
    spelling is absent.
    """
    have = set(df.columns)
    renames = {old: new for old, new in FEED_RENAMES.get(feed, {}).items() if old in have}
    renames |= {old: new for old, new in aliases.items() if old in have and new not in have}
    return df.withColumnsRenamed(renames) if renames else df


def to_type(field: T.StructField, target: str) -> str:
    """One column brought to a type; unreadable or blank text becomes NULL.

    Only text columns get the blank test: wrapping a numeric column in string
    functions would keep its filters from reaching the Parquet scan.
    """
    c = f"`{field.name}`"
    if not isinstance(field.dataType, T.StringType):
        return c if field.dataType.simpleString() == target else f"try_cast({c} as {target})"
    text = f"nullif(trim({c}), '')"
    if target == "bigint":
        # "1.0" is no long to try_cast, while a long id would lose digits as a double.
        return f"coalesce(try_cast({text} as bigint), try_cast(try_cast({text} as double) as bigint))"
    return f"try_cast({text} as {target})"


def enforce_types(df: DataFrame, types: Mapping[str, str] = STABLE_TYPES) -> DataFrame:
    """Bring the known columns to their types in one projection; others pass through."""
    return df.selectExpr(*[
        f"{to_type(f, types[f.name]) if f.name in types else f'`{f.name}`'} as `{f.name}`"
        for f in df.schema.fields
    ])


def quality_rules() -> dict[str, str]:
    """What a raw row must satisfy, by name; a NULL answer counts as a failure."""
    return {
        "pickup_datetime_missing": "pickup_datetime is not null",
        "dropoff_datetime_missing": "dropoff_datetime is not null",
        "pickup_zone_missing": "PULocationID is not null",
        "dropoff_zone_missing": "DOLocationID is not null",
        "distance_out_of_range": f"trip_distance > 0 and trip_distance < {MAX_DISTANCE}",
        "total_out_of_range": f"total_amount > 0 and total_amount < {MAX_TOTAL}",
        "passengers_missing": "passenger_count is not null",
        "passengers_out_of_range": f"passenger_count between {MIN_PASSENGERS} and {MAX_PASSENGERS}",
    }


def sanity_rules() -> dict[str, str]:
    """What a derived row must satisfy."""
    return {
        "duration_out_of_range": f"trip_duration_min > {MIN_MINUTES} and trip_duration_min < {MAX_MINUTES}",
        "speed_out_of_range": f"speed_mph is null or speed_mph < {MAX_SPEED}",
    }


def gate(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep the rows that satisfy every rule."""
    return df.where(" and ".join(f"({rule})" for rule in rules.values()))


def reject_breakdown(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows per first failed rule, ``kept`` for the rest, with their share in percent.

    Rules are tried in order, so every row counts once. One scan, and each task
    sends a single row of counts.
    """
    tests = " ".join(f"when not coalesce({rule}, false) then '{name}'" for name, rule in rules.items())
    names = [*rules, "kept"]
    one_pass = df.selectExpr(f"case {tests} else 'kept' end as verdict").agg(
        F.expr("count(1) as all_rows"),
        *[F.expr(f"count_if(verdict = '{n}') as `{n}`") for n in names],
    )
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return one_pass.selectExpr("all_rows", f"stack({len(names)}, {pairs}) as (reason, row_count)").selectExpr(
        "reason", "row_count",
        "case when all_rows > 0 then row_count * 100D / all_rows end as percent",
    )


def with_pace(df: DataFrame) -> DataFrame:
    """Duration in minutes and speed."""
    return df.selectExpr(
        "*", f"{ft.minutes_between('pickup_datetime', 'dropoff_datetime')} as trip_duration_min"
    ).selectExpr("*", f"{ft.miles_per_hour('trip_distance', 'trip_duration_min')} as speed_mph")


def derive_trip_features(df: DataFrame, feed: str | None = None) -> DataFrame:
    """Duration, speed, calendar parts, feed name and trip id.

    Without ``feed`` the frame already names it in ``vehicle_type``.
    """
    named = [f"'{feed}' as vehicle_type"] if feed else []
    return with_pace(df).selectExpr(
        "*", *named,
        "to_date(pickup_datetime) as pickup_date",
        "year(pickup_datetime) as pickup_year",
        "month(pickup_datetime) as pickup_month",
        "hour(pickup_datetime) as pickup_hour",
        "dayofweek(pickup_datetime) as pickup_dow",
        f"{ft.trip_hash_id(TRIP_ID_FIELDS)} as trip_id",
    )


def month_fence(df: DataFrame, year: int, month: int, ts: str = "pickup_datetime") -> DataFrame:
    """Rows of one calendar month, as a range that the Parquet scan can use."""
    first = date(year, month, 1)
    after = date(year + month // 12, month % 12 + 1, 1)
    kind = df.schema[ts].dataType.simpleString()
    return df.where(f"{ts} >= cast('{first}' as {kind}) and {ts} < cast('{after}' as {kind})")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, then by every other column.

    The survivor is the same on every run. Spark turns ``row_number() = 1``
    into a per-task group limit ahead of the shuffle, so a key holding a large
    share of the rows sends at most one row per task to its reducer.
    """
    lead = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in lead]
    first = Window.partitionBy(*keys).orderBy(*lead, *rest)
    return df.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")


def cleanse(df: DataFrame, feed: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """A raw feed as clean trips.

    The month fence comes before deduplication: copies share a pickup time, so
    the result is the same and other months never reach the shuffle. Copies are
    matched on the fields of the id, and the id and all other derived columns
    are added after the shuffle, which then carries the raw columns only.
    """
    typed = enforce_types(normalize_columns(df, feed))
    if year is not None and month is not None:
        typed = month_fence(typed, year, month)
    paced = gate(with_pace(gate(typed, quality_rules())), sanity_rules())
    return derive_trip_features(dedup(paced.select(*typed.columns), TRIP_ID_FIELDS), feed)
