"""The joined-up run: admission, gate, catalog, log, work list; and the contracts of all layers."""

import uuid
from datetime import date, datetime

import pytest
import side_by_side
from pyspark.sql import functions as F

from curbline import schema
from curbline.operators import quality as q
from curbline.plans import checking, monthly, pipeline, warehouse
from curbline.sources import readers
from curbline.workload import adapter as ad
from curbline.workload import catalogue as c

ONE_ROW = [q.Check("rows", "row_count", low=1), q.Check("id", "not_null", "trip_id"),
           q.Check("fare", "between", "fare_amount", 0, 100)]
CLOCKS = {"yellow": "tpep", "green": "lpep"}


def land(spark, root, feed, month, rows, drop=(), fare=14.0):
    year, number = map(int, month.split("-"))
    at = [datetime(year, number, 15, 8 + i % 3) for i in range(rows)]
    df = spark.createDataFrame(
        [(1, t, datetime(year, number, 15, 12), 2, 3.5, 1, "N", 1, 2, 1, fare + i / 100, 0.5, 0.5, 2.0, 0.0, 0.3, 17.3, 2.5)
         for i, t in enumerate(at)],
        f"VendorID bigint, {CLOCKS[feed]}_pickup_datetime timestamp_ntz, {CLOCKS[feed]}_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, PULocationID bigint, "
        "DOLocationID bigint, payment_type bigint, fare_amount double, extra double, mta_tax double, tip_amount double, "
        "tolls_amount double, improvement_surcharge double, total_amount double, congestion_surcharge double")
    df.drop(*drop).write.parquet(readers.raw_month_path(root, feed, year, number))


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "Manhattan", "Midtown", "Yellow Zone"), (2, "Queens", "JFK Airport", "Airports")],
                                 readers.ZONE_SCHEMA)


@pytest.fixture
def database(spark):
    name = f"run_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_months_from_landing_to_catalog(spark, tmp_path, zones, database):
    root = str(tmp_path)
    for feed in CLOCKS:
        land(spark, root, feed, "2023-03", 6)
        land(spark, root, feed, "2023-04", 6, drop=("payment_type",) if feed == "green" else ())
        land(spark, root, feed, "2023-05", 6, fare=500.0)
    land(spark, root, "yellow", "2023-06", 6)
    options = dict(checks=ONE_ROW, min_rows=1)
    runs = pipeline.run_months(spark, root, "2023-03-01", "2023-07-01", zones, database, **options)
    assert [(r.month.month, r.status, r.findings) for r in runs] == [
        (3, "published", ()), (4, "not admitted", ("green: missing_column: payment_type",)), (5, "stopped", ("fare",))]
    assert (runs[0].trips, runs[0].hours) == (6, 3)                     # three hours, two feeds, copies gone
    # What was decided is read back, and decides what is left to do.
    assert {(r.month, r.status, tuple(r.findings), r.trips) for r in pipeline.run_log(spark, root).collect()} == {
        (r.month, r.status, r.findings, r.trips) for r in runs}
    plan = {r.month_start.month: r.status for r in pipeline.month_plan(spark, root, "2023-03-01", "2023-07-01").collect()}
    assert plan == {3: "published", 4: "pending", 5: "pending", 6: "missing", 7: "missing"}
    # Only the published month is seen through the catalog; the others lie in quarantine.
    for table in pipeline.MONTH_TABLES:
        seen = spark.table(f"{database}.{table.replace('/', '_')}")
        assert {(r.pickup_year, r.pickup_month) for r in seen.select(*schema.PARTITION_KEYS).distinct().collect()} == {(2023, 3)}
        listed = spark.read.text(f"{root}/manifests/{table}/2023-03").count()
        assert listed == readers.file_listing(spark, f"{root}/{table}/pickup_year=2023/pickup_month=3").count() > 0
    assert spark.table(f"{database}.gold_fact_trips").count() == 6
    assert spark.read.parquet(f"{root}/quarantine/bronze/green/2023-04").count() == 6
    assert spark.read.parquet(f"{root}/quarantine/fact_trips").where("pickup_month = 5").count() == 6
    assert spark.read.json(f"{root}/reports/trips").where("check_id = 'fare' and not success").count() == 1
    assert spark.read.json(f"{root}/reports/marts").where("not success").count() == 0


def test_a_repaired_month_is_taken_up_again(spark, tmp_path, zones, database):
    root = str(tmp_path)
    land(spark, root, "yellow", "2023-03", 3)
    land(spark, root, "green", "2023-03", 3, drop=("PULocationID",))
    options = dict(checks=ONE_ROW, min_rows=1)
    first = pipeline.run_months(spark, root, "2023-03-01", "2023-03-01", zones, database, **options)
    assert first[0].status == "not admitted"
    assert spark.table(f"{database}.gold_fact_trips").count() == 0     # entered, and empty until a month passes
    spark.read.parquet(f"{root}/bronze/green/2023-03").withColumn("PULocationID", F.lit(2).cast("long")).write.parquet(f"{root}/fixed")
    spark.read.parquet(f"{root}/fixed").write.mode("overwrite").parquet(f"{root}/bronze/green/2023-03")
    again = pipeline.run_months(spark, root, "2023-03-01", "2023-03-01", zones, database, **options)
    assert [(r.status, r.trips) for r in again] == [("published", 6)]
    assert pipeline.run_months(spark, root, "2023-03-01", "2023-03-01", zones, database, **options) == []


def test_a_failing_month_does_not_stop_the_next(spark, tmp_path, zones, database):
    root = str(tmp_path)
    for month in ("2023-03", "2023-04"):
        for feed in CLOCKS:
            land(spark, root, feed, month, 3)
    def broken(df, contract):
        raise ValueError("contract of silver")
    kept = monthly.declared
    calls = []
    def once(df, contract):
        calls.append(1)
        return broken(df, contract) if len(calls) == 1 else kept(df, contract)
    monthly.declared = once
    try:
        runs = pipeline.run_months(spark, root, "2023-03-01", "2023-04-01", zones, database, checks=ONE_ROW, min_rows=1)
    finally:
        monthly.declared = kept
    assert [(r.month, r.status) for r in runs] == [(date(2023, 3, 1), "failed"), (date(2023, 4, 1), "published")]
    assert runs[0].findings == ("contract of silver",)


def test_admission_reads_footers_only(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "yellow", "2023-03", 120)
    assert checking.admit_month(spark, root, "yellow", 2023, 3) == []
    assert checking.admit_month(spark, root, "yellow", 2023, 4) == ["not_landed"]
    land(spark, root, "yellow", "2023-05", 99)
    assert checking.admit_month(spark, root, "yellow", 2023, 5) == ["too_few_rows"]
    nulls = spark.read.parquet(f"{root}/bronze/yellow/2023-03").withColumn("fare_amount", F.lit(None).cast("double"))
    nulls.write.parquet(f"{root}/bronze/yellow/2023-06")
    assert checking.admit_month(spark, root, "yellow", 2023, 6) == ["mostly_null: fare_amount"]
    nulls.limit(0).write.parquet(f"{root}/bronze/yellow/2023-07")
    assert "too_few_rows" in checking.admit_month(spark, root, "yellow", 2023, 7)
    # The counts of the footers are those of the rows.
    for month in ("2023-03", "2023-05", "2023-06", "2023-07"):
        raw = spark.read.parquet(f"{root}/bronze/yellow/{month}")
        read = {tuple(r) for r in q.file_contract(raw, "yellow").collect()}
        from curbline.sources import footers
        counts = footers.footer_counts(spark, f"{root}/bronze/yellow/{month}")
        assert {tuple(r) for r in q.file_contract(raw, "yellow", counts=counts).collect()} == read


# ---- contracts ---------------------------------------------------------------

LAYERS = {
    "silver": (schema.SILVER, ad.SANE, c.silver), "gold": (schema.GOLD_FACT, ad.GOLD, c.gold),
    "kpi": (schema.GOLD_KPI, ad.KPI, c.kpis), "staged": (schema.STAGED, ad.STAGED, lambda s, f: warehouse.staged(c.typed(s, f))),
    "fact": (schema.FACT_TRIPS, ad.KEYED_FACT, lambda s, f: c.unkeyed_fact(s, f).withColumn("trip_id", F.lit(""))),
    "locations": (schema.DIM_LOCATION, ad.LOCATIONS, c.locations), "days": (schema.DIM_DATETIME, ad.DAYS, c.days),
    "mart": (schema.MART_HOURLY, ad.MART, c.mart),
}
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
         "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("layer", LAYERS)
def test_contract_is_what_is_built(spark, sf, layer):
    contract, parts, build = LAYERS[layer]
    df = build(spark, sf)
    assert schema.schema_gaps(df, contract, schema.PARTITION_KEYS) == []
    rows = side_by_side.duck(sf).execute("describe " + ad.with_sql(*parts, final=f"select * from {layer}")).fetchall()
    want = {name: TYPES[kind] for name, kind, *_ in rows if name not in schema.PARTITION_KEYS}
    assert {f.name: f.dataType.simpleString() for f in contract.fields} == want
    first = contract.fields[-1].name
    with pytest.raises(ValueError, match=f"missing {first}"):
        schema.assert_schema(df.drop(first), contract, schema.PARTITION_KEYS)


def test_vintage_columns_are_filled_and_needed_ones_are_not(spark, sf):
    trips = c.silver(spark, sf)
    filled = monthly.declared(trips.drop("ehail_fee", "extra"), schema.SILVER)
    assert filled.schema["ehail_fee"].dataType.simpleString() == "double"
    assert "new_fee" in monthly.declared(trips.withColumn("new_fee", F.lit(1.0)), schema.SILVER).columns
    for column in ("fare_amount", "trip_id", "speed_mph", "pickup_datetime"):
        with pytest.raises(ValueError, match=f"missing {column}"):
            monthly.declared(trips.drop(column), schema.SILVER)
    with pytest.raises(ValueError, match="type of fare_amount"):
        monthly.declared(trips.withColumn("fare_amount", F.lit("1")), schema.SILVER)
