"""Table contracts and the checks that hold frames to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the published tables. Clocks carry no zone.
RAW_COLUMNS = {
    "VendorID": "long",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "long",
    "trip_distance": "double",
    "RatecodeID": "long",
    "store_and_fwd_flag": "string",
    "PULocationID": "long",
    "DOLocationID": "long",
    "payment_type": "long",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
    "cbd_congestion_fee": "double",
    "ehail_fee": "double",
    "trip_type": "long",
}
DERIVED_COLUMNS = {
    "trip_duration_min": "double",
    "speed_mph": "double",
    "pickup_date": "date",
    "pickup_hour": "integer",
    "pickup_dow": "integer",
    "vehicle_type": "string",
    "trip_id": "string",
}
ENRICHED_COLUMNS = {
    "pickup_borough": "string",
    "pickup_zone": "string",
    "pickup_service_zone": "string",
    "dropoff_borough": "string",
    "dropoff_zone": "string",
    "payment_type_name": "string",
    "tip_rate": "double",
    "is_airport_trip": "boolean",
    "is_weekend": "boolean",
    "time_of_day": "string",
}
KPI_COLUMNS = {
    "pickup_date": "date",
    "pickup_hour": "integer",
    "pickup_borough": "string",
    "trip_count": "long",
    "total_revenue": "double",
    "avg_fare": "double",
    "avg_distance_mi": "double",
    "avg_duration_min": "double",
    "avg_tip_rate": "double",
    "airport_trips": "long",
    "weekend_trips": "long",
    "unique_pickup_zones": "long",
    "pickup_datetime_hour": "timestamp_ntz",
    "rolling_7d_trips": "double",
    "rolling_7d_revenue": "double",
    "revenue_per_mile": "double",
}
_STAGED_MEASURES = {
    "store_and_fwd_flag": "string",
    "passenger_count": "integer",
    "trip_distance_miles": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
    "pickup_at": "timestamp_ntz",
    "dropoff_at": "timestamp_ntz",
    "pickup_date": "date",
    "pickup_hour": "integer",
    "trip_duration_seconds": "long",
    "cab_type": "string",
}
_PLACES = {"vendor_id": "integer", "pickup_location_id": "integer", "dropoff_location_id": "integer"}
STAGED_COLUMNS = _PLACES | {"rate_code_id": "integer", "payment_type_id": "integer"} | _STAGED_MEASURES
FACT_COLUMNS = _PLACES | _STAGED_MEASURES | {
    "trip_id": "string",
    "payment_type": "string",
    "rate_code": "string",
    "avg_speed_mph": "double",
    "tip_pct": "double",
    "revenue_per_mile": "double",
}
LOCATION_COLUMNS = {
    "location_id": "integer",
    "zone_name": "string",
    "borough": "string",
    "service_zone": "string",
    "borough_group": "string",
    "is_airport": "boolean",
    "is_manhattan_cbd": "boolean",
}
CALENDAR_COLUMNS = {
    "date_day": "date",
    "year": "integer",
    "month": "integer",
    "day_of_month": "integer",
    "day_of_week": "integer",
    "week_of_year": "integer",
    "quarter": "integer",
    "year_month": "string",
    "day_name": "string",
    "month_name": "string",
    "year_quarter": "string",
    "is_weekend": "boolean",
    "us_holiday_name": "string",
    "is_us_holiday": "boolean",
}
MART_COLUMNS = {
    "pickup_date": "date",
    "pickup_hour": "integer",
    "cab_type": "string",
    "borough_group": "string",
    "is_airport": "boolean",
    "is_manhattan_cbd": "boolean",
    "trip_count": "long",
    "total_passengers": "long",
    "total_distance_miles": "double",
    "avg_distance_miles": "double",
    "avg_duration_minutes": "double",
    "median_duration_minutes": "double",
    "avg_speed_mph": "double",
    "total_fare": "double",
    "total_tips": "double",
    "total_revenue": "double",
    "avg_revenue_per_trip": "double",
    "avg_tip_pct": "double",
    "total_congestion_surcharge": "double",
    "total_airport_fee": "double",
    "credit_card_trips": "long",
    "cash_trips": "long",
    "revenue_per_trip": "double",
    "is_weekend": "boolean",
    "is_us_holiday": "boolean",
    "day_name": "string",
    "month_name": "string",
    "year_month": "string",
    "year_quarter": "string",
}


def _table(columns: Mapping[str, str]) -> T.StructType:
    made = T.StructType()
    for name, kind in columns.items():
        made = made.add(name, kind)
    return made


SILVER = _table(RAW_COLUMNS | DERIVED_COLUMNS)
GOLD_FACT = _table(RAW_COLUMNS | DERIVED_COLUMNS | ENRICHED_COLUMNS)
GOLD_KPI = _table(KPI_COLUMNS)
STAGED = _table(STAGED_COLUMNS)
FACT_TRIPS = _table(FACT_COLUMNS)
DIM_LOCATION = _table(LOCATION_COLUMNS)
DIM_DATETIME = _table(CALENDAR_COLUMNS)
MART_HOURLY = _table(MART_COLUMNS)

# The type every known raw column is brought to; text stays as it is.
STABLE_TYPES: dict[str, str] = {
    f.name: f.dataType.simpleString() for f in SILVER.fields
    if f.name in RAW_COLUMNS and f.dataType != T.StringType()
}

# Raw spellings per feed, and spellings that changed between vintages.
FEED_RENAMES: dict[str, dict[str, str]] = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
}
VINTAGE_ALIASES: dict[str, str] = {"Airport_fee": "airport_fee"}

# Columns a raw file must and may carry.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
               "PULocationID", "DOLocationID", "fare_amount", "total_amount", "payment_type"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime", "passenger_count", "trip_distance",
              "PULocationID", "DOLocationID", "fare_amount", "total_amount", "payment_type"),
    "fhv": ("dispatching_base_num", "pickup_datetime", "dropOff_datetime", "PUlocationID",
            "DOlocationID"),
    "fhvhv": ("hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
              "PULocationID", "DOLocationID", "base_passenger_fare", "tolls", "tips", "driver_pay"),
}
# The required columns of a trip feed under their canonical names.
REQUIRED_RAW = {FEED_RENAMES["yellow"].get(c, c) for c in REQUIRED_COLUMNS["yellow"]}
OPTIONAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "yellow": ("cbd_congestion_surcharge",),
    "green": ("cbd_congestion_surcharge",),
    "fhv": (),
    "fhvhv": ("cbd_congestion_surcharge",),
}

PARTITION_KEYS = ("pickup_year", "pickup_month")


def schema_gaps(df: DataFrame, contract: T.StructType, ignore: Sequence[str] = ()) -> list[str]:
    """Differences between a frame and a contract, as readable lines; empty when it holds."""
    have = {f.name: f.dataType for f in df.schema.fields if f.name not in ignore}
    want = {f.name: f.dataType for f in contract.fields}
    lines = [f"missing {n}" for n in want if n not in have]
    lines += [f"undeclared {n}" for n in have if n not in want]
    for n in want.keys() & have.keys():
        if not _same(have[n], want[n]):
            lines.append(f"type of {n}: {have[n].simpleString()} for {want[n].simpleString()}")
    return sorted(lines)


def _same(a: T.DataType, b: T.DataType) -> bool:
    stamps = (T.TimestampType, T.TimestampNTZType)
    return a == b or (isinstance(a, stamps) and isinstance(b, stamps))


def assert_schema(df: DataFrame, contract: T.StructType, ignore: Sequence[str] = ()) -> DataFrame:
    """Return the frame, or raise with every difference named."""
    gaps = schema_gaps(df, contract, ignore)
    if gaps:
        raise ValueError("schema contract broken: " + "; ".join(gaps))
    return df


def assert_additive(existing: T.StructType, new: T.StructType) -> None:
    """New columns may appear; a column may not change its type.

    A batch may leave columns out: they read back as NULL.
    """
    before = {f.name.lower(): f for f in existing.fields}
    clashes = [
        f"{f.name}: {before[f.name.lower()].dataType.simpleString()} to {f.dataType.simpleString()}"
        for f in new.fields
        if f.name.lower() in before and not _same(before[f.name.lower()].dataType, f.dataType)
    ]
    if clashes:
        raise ValueError("not an additive change: " + "; ".join(clashes))


def column_differences(
    df: DataFrame, feed: str, required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
    optional: Mapping[str, Sequence[str]] = OPTIONAL_COLUMNS,
) -> tuple[list[str], list[str]]:
    """(missing required, unexpected) column names for a feed, sorted."""
    have = set(df.columns)
    need = set(required[feed])
    return sorted(need - have), sorted(have - need - set(optional.get(feed, ())))


def differences_frame(spark: SparkSession, df: DataFrame, feed: str) -> DataFrame:
    """The column differences as rows: (feed, column_name, finding)."""
    missing, unexpected = column_differences(df, feed)
    rows = [(feed, c, "missing") for c in missing] + [(feed, c, "unexpected") for c in unexpected]
    return spark.createDataFrame(rows, "feed string, column_name string, finding string")
