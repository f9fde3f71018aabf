from datetime import datetime

import pytest

from curbline.functions import trip as ft
from curbline.operators import clean
from curbline.schema import SILVER, assert_additive, assert_schema, schema_gaps


def trips(spark, **over):
    row = dict(
        VendorID=1, pickup_datetime=datetime(2023, 3, 15, 8), dropoff_datetime=datetime(2023, 3, 15, 8, 30),
        passenger_count=2, trip_distance=3.5, PULocationID=100, DOLocationID=200, total_amount=17.3,
        fare_amount=14.0,
    )
    row.update(over)
    return spark.createDataFrame(
        [tuple(row.values())],
        "VendorID bigint, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, PULocationID bigint, DOLocationID bigint, "
        "total_amount double, fare_amount double",
    )


@pytest.mark.parametrize("text,whole,real", [
    ("1", 1, 1.0), ("1.0", 1, 1.0), ("1.7", 1, 1.7), ("", None, None), ("   ", None, None),
    ("abc", None, None), (None, None, None), (" 5 ", 5, 5.0), ("9007199254740993", 9007199254740993, None),
])
def test_typed_text(spark, text, whole, real):
    df = spark.createDataFrame([(text, text, "x")], "VendorID string, fare_amount string, other string")
    got = clean.enforce_types(df).first()
    assert got.VendorID == whole
    assert got.other == "x"
    if real is not None or whole is None:
        assert got.fare_amount == real


def test_numeric_columns_stay_bare(spark):
    df = spark.createDataFrame([(1.0, 2)], "trip_distance double, passenger_count int")
    plan = clean.enforce_types(df)
    assert dict(plan.dtypes) == {"trip_distance": "double", "passenger_count": "bigint"}


def test_vintage_alias_needs_exact_absence(spark):
    df = spark.createDataFrame([(1.0, 2)], "Airport_fee double, tpep_pickup_datetime int")
    assert clean.normalize_columns(df, "yellow").columns == ["airport_fee", "pickup_datetime"]
    kept = spark.createDataFrame([(1.0,)], "airport_fee double")
    assert clean.normalize_columns(kept, "yellow").columns == ["airport_fee"]


@pytest.mark.parametrize("over,kept", [
    ({}, 1), ({"trip_distance": 0.0}, 0), ({"trip_distance": 199.99}, 1), ({"trip_distance": 200.0}, 0),
    ({"passenger_count": 0}, 0), ({"passenger_count": 1}, 1), ({"passenger_count": 6}, 1),
    ({"passenger_count": 7}, 0), ({"passenger_count": None}, 0), ({"total_amount": 0.0}, 0),
    ({"total_amount": -5.0}, 0), ({"total_amount": 4999.99}, 1), ({"total_amount": 5000.0}, 0),
    ({"PULocationID": None}, 0), ({"DOLocationID": None}, 0), ({"dropoff_datetime": None}, 0),
])
def test_quality_gate(spark, over, kept):
    assert clean.gate(trips(spark, **over), clean.quality_rules()).count() == kept


@pytest.mark.parametrize("minutes,speed,kept", [
    (1.0, 20.0, 0), (1.01, 20.0, 1), (299.99, 20.0, 1), (300.0, 20.0, 0), (30.0, 119.99, 1),
    (30.0, 120.0, 0), (30.0, None, 1),
])
def test_sanity_gate(spark, minutes, speed, kept):
    df = spark.createDataFrame([(minutes, speed)], "trip_duration_min double, speed_mph double")
    assert clean.gate(df, clean.sanity_rules()).count() == kept


def test_derived_features(spark):
    row = clean.derive_trip_features(trips(spark), "yellow").first()
    assert (row.trip_duration_min, row.speed_mph) == (30.0, 7.0)
    assert (row.pickup_year, row.pickup_month, row.pickup_hour, row.pickup_dow) == (2023, 3, 8, 4)
    assert row.vehicle_type == "yellow" and len(row.trip_id) == 64


def test_hash_skips_nulls_and_key_hash_does_not(spark):
    df = spark.createDataFrame([(None, "a")], "x string, y string")
    row = df.selectExpr(f"{ft.trip_hash_id(['x', 'y'])} as a", f"{ft.natural_key_hash(['x', 'y'], 'y')} as b",
                        "sha2('a', 256) as c").first()
    assert row.a == row.c and row.b is None


@pytest.mark.parametrize("hour,band", [
    (5, "late_night"), (6, "morning_rush"), (9, "morning_rush"), (10, "midday"), (15, "midday"),
    (16, "evening_rush"), (20, "evening_rush"), (21, "night"), (23, "night"), (0, "late_night"),
])
def test_time_of_day(spark, hour, band):
    assert spark.range(1).selectExpr(f"{ft.time_of_day(str(hour))} as b").first().b == band


@pytest.mark.parametrize("fare,rate,percent", [(10.0, 0.25, 25.0), (0.0, 0.0, None), (-1.0, 0.0, None),
                                               (None, 0.0, None)])
def test_tips(spark, fare, rate, percent):
    df = spark.createDataFrame([(fare, 2.5)], "fare double, tip double")
    row = df.selectExpr(f"{ft.tip_rate('tip', 'fare')} as r", f"{ft.tip_percent('tip', 'fare')} as p").first()
    assert (row.r, row.p) == (rate, percent)


def test_dedup_is_reproducible(spark):
    rows = [(i % 10, i) for i in range(1000)] + [(3, 5000 + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int")
    want = {(k, k) for k in range(10)}
    for parts in (1, 7):
        got = clean.dedup(df.repartition(parts), ["k"], ["v"]).collect()
        assert {tuple(r) for r in got} == want


def test_month_fence_before_dedup_changes_nothing(spark):
    late = trips(spark, pickup_datetime=datetime(2023, 4, 1), dropoff_datetime=datetime(2023, 4, 1, 0, 30))
    raw = trips(spark).union(trips(spark)).union(late).withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )
    assert clean.cleanse(raw, "yellow").count() == 2
    assert clean.cleanse(raw, "yellow", 2023, 3).count() == 1
    assert clean.cleanse(raw, "yellow", 2022, 12).count() == 0


def test_rejects_add_up(spark):
    df = clean.derive_trip_features(
        trips(spark).union(trips(spark, passenger_count=None)).union(trips(spark, trip_distance=0.0)), "yellow"
    )
    report = {r.reason: r.row_count for r in clean.reject_breakdown(
        df, {**clean.quality_rules(), **clean.sanity_rules()}).collect()}
    assert sum(report.values()) == 3
    assert report["kept"] == report["passengers_missing"] == report["distance_out_of_range"] == 1


def test_contracts(spark):
    df = spark.createDataFrame([], SILVER)
    assert_schema(df, SILVER)
    assert schema_gaps(df.drop("trip_id"), SILVER) == ["missing trip_id"]
    with pytest.raises(ValueError, match="undeclared more"):
        assert_schema(df.selectExpr("*", "1 as more"), SILVER)
    assert_additive(df.schema, df.selectExpr("*", "1 as more").schema)
    with pytest.raises(ValueError, match="VendorID"):
        assert_additive(df.schema, df.selectExpr("cast(VendorID as string) as VendorID").schema)
