from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.operators import incremental, marts
from curbline.operators.quality import TRIP_SUITE
from curbline.plans import checking, monthly, warehouse
from curbline.session import shared_folder
from curbline.sources import catalog, readers, sinks, spines
from curbline.streaming import landing
from curbline.workload import adapter, catalogue


def months(spark, rows):
    return spark.createDataFrame(rows, "id int, amount double, y int, m int")


def content(spark, path):
    return sorted((r.id, r.amount, r.y, r.m) for r in readers.read_evolved(spark, path).collect())


def test_replace_partition_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)]), path, ["y", "m"])
    batch = months(spark, [(9, 9.0, 2023, 2)])
    for _ in range(2):
        assert sinks.replace_partition(batch, path, {"y": 2023, "m": 2}) == 1
        assert content(spark, path) == [(1, 1.0, 2023, 1), (9, 9.0, 2023, 2)]


def test_empty_batch_empties_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)]), path, ["y", "m"])
    assert sinks.replace_partition(months(spark, []), path, {"y": 2023, "m": 2}) == 0
    assert content(spark, path) == [(1, 1.0, 2023, 1)]


@pytest.mark.parametrize("stray", [(3, 3.0, 2023, 3), (3, 3.0, 2023, None)])
def test_stray_row_leaves_the_table_alone(spark, tmp_path, stray):
    path = str(tmp_path / "t")
    sinks.write_partitioned(months(spark, [(2, 2.0, 2023, 2)]), path, ["y", "m"])
    with pytest.raises(Exception, match="row outside"):
        sinks.replace_partition(months(spark, [(9, 9.0, 2023, 2), stray]), path, {"y": 2023, "m": 2})
    assert content(spark, path) == [(2, 2.0, 2023, 2)]


def test_insert_overwrite_touches_present_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)])
    sinks.insert_overwrite(base, path, ["y", "m"])
    for _ in range(2):
        sinks.insert_overwrite(months(spark, [(7, 7.0, 2023, 2), (8, 8.0, 2023, 3)]), path, ["y", "m"])
    assert content(spark, path) == [(1, 1.0, 2023, 1), (7, 7.0, 2023, 2), (8, 8.0, 2023, 3)]


def test_new_column_is_null_in_older_files_and_retyping_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(months(spark, [(1, 1.0, 2023, 1)]), path, ["y", "m"])
    wider = months(spark, [(2, 2.0, 2023, 2)]).selectExpr("*", "5D as fee")
    sinks.replace_partition(wider, path, {"y": 2023, "m": 2})
    assert sorted((r.id, r.fee) for r in readers.read_evolved(spark, path).collect()) == [(1, None), (2, 5.0)]
    with pytest.raises(ValueError, match="amount"):
        sinks.insert_overwrite(
            months(spark, [(3, 3.0, 2023, 3)]).selectExpr("id", "'x' as amount", "y", "m"), path, ["y", "m"]
        )


def test_month_scan_reads_one_directory(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)]
    sinks.write_partitioned(months(spark, rows), path, ["y", "m"])
    picked = readers.read_month(spark, path, 2023, 2, keys=("y", "m"))
    assert all("/y=2023/m=2/" in f for f in picked.inputFiles())
    assert [(r.id, r.y, r.m) for r in picked.collect()] == [(2, 2023, 2)]
    assert readers.read_month(spark, path, 2023, 9, keys=("y", "m")).count() == 0
    pruned = readers.read_evolved(spark, path).where("y = 2023 and m = 2")
    assert "PartitionFilters: [isnotnull(y" in pruned._jdf.queryExecution().executedPlan().toString()


def test_manifest_lists_live_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)]), path, ["y", "m"])
    listed = readers.file_manifest(spark.read.parquet(path), ["y", "m"])
    assert {(r.y, r.m) for r in listed.collect()} == {(2023, 1), (2023, 2)}
    sinks.write_manifest(listed, str(tmp_path / "manifest"), ["y", "m"])
    assert spark.read.text(str(tmp_path / "manifest")).count() == listed.count()


def test_materialisation_modes(spark, tmp_path):
    df = months(spark, [(1, 1.0, 2023, 1)])
    sinks.materialize(df, "model_view", "view")
    assert spark.table("model_view").count() == 1
    sinks.materialize(df, "model_table", "table")
    sinks.materialize(df, "model_table", "table")
    assert spark.table("model_table").count() == 1
    path = str(tmp_path / "inc")
    sinks.materialize(df, "model_inc", "incremental", path, ["y", "m"])
    sinks.materialize(months(spark, [(2, 2.0, 2023, 2)]), "model_inc", "incremental", path, ["y", "m"])
    assert len(content(spark, path)) == 2
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "snapshot")


def test_catalog_entries(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)])
    sinks.write_partitioned(df, path, ["y", "m"])
    base = df.drop("y", "m").schema
    for _ in range(2):
        catalog.register_table(spark, "lake", "trips", path, base, {"y": "int", "m": "int"})
    catalog.register_partition(spark, "lake", "trips", {"y": "2023", "m": "01"}, f"{path}/y=2023/m=1")
    assert spark.table("lake.trips").count() == 1
    catalog.repair_table(spark, "lake", "trips")
    assert spark.table("lake.trips").count() == 2
    wider = df.drop("y", "m").selectExpr("*", "1D as fee").schema
    catalog.register_table(spark, "lake", "trips", path, wider, {"y": "int", "m": "int"})
    assert "fee" in spark.table("lake.trips").columns
    spark.sql("DROP DATABASE lake CASCADE")


def test_report_and_quarantine(spark, tmp_path):
    df = months(spark, [(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)])
    source, aside = str(tmp_path / "t"), str(tmp_path / "q")
    sinks.write_partitioned(df, source, ["y", "m"])
    sinks.quarantine(readers.read_month(spark, source, 2023, 1, keys=("y", "m")), aside, ["y", "m"])
    assert content(spark, aside) == [(1, 1.0, 2023, 1)]
    assert len(content(spark, source)) == 2
    sinks.write_report(df, str(tmp_path / "r"), "suite", date(2023, 1, 1))
    assert spark.read.json(str(tmp_path / "r")).count() == 2


def test_lookback_edges(spark):
    df = spark.createDataFrame([(date(2023, 1, d),) for d in (6, 7, 8, 10)], "day date")
    got = incremental.lookback(df, "day", incremental.latest_day(df, "day"))
    assert sorted(r.day.day for r in got.collect()) == [7, 8, 10]
    assert incremental.lookback(df.limit(0), "day", "2023-01-10").count() == 0


def test_spines(spark):
    days = [r.date_day for r in spines.date_spine(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    grid = spines.expected_partitions(spark, spines.ALL_FEEDS, "2025-11-15", "2026-02-01")
    assert grid.count() == 16
    gone = spark.createDataFrame(spines.unpublished_months(), "feed string, month_start date")
    assert gone.where("month_start = date'2026-01-01'").count() == 1
    assert gone.where("month_start = date'2026-05-01'").count() == 4
    landed = spark.createDataFrame([("yellow", date(2025, 11, 1))], "feed string, month_start date")
    plan = incremental.coverage(grid, landed, gone)
    assert {r.status: r["count"] for r in plan.groupBy("status").count().collect()} == {
        "exists": 1, "unavailable": 3, "missing": 12}
    assert incremental.work_list(grid, landed, gone).count() == 12
    flagged = grid.select("feed", "month_start", spines.has_column_since("feed", "month_start").alias("f"))
    assert flagged.where("f and feed = 'fhv'").isEmpty()


def test_csv_zones(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n265,"N/A","N/A","N/A"\n')
    rows = readers.read_zones(spark, str(file)).collect()
    assert [(r.LocationID, r.Borough) for r in rows] == [(1, "EWR"), (265, "N/A")]
    assert readers.load_seed(readers.read_zones(spark, str(file))).columns[0] == "location_id"


@pytest.mark.parametrize("name,feed", [("yellow_2023-01.parquet", "yellow"), ("fhvhv_x", "fhvhv"),
                                       ("fhv_x", "fhv"), ("good.parquet", None)])
def test_feed_from_name(spark, name, feed):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(readers.feed_from_file_name("n").alias("f")).first().f == feed


def bronze(spark, root, feed, prefix, rows, month="2023-03"):
    df = spark.createDataFrame(rows, (
        f"VendorID bigint, {prefix}_pickup_datetime timestamp_ntz, {prefix}_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
        "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
        "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double"))
    if feed == "yellow":
        df = df.selectExpr("*", "1.25D as Airport_fee")
    df.write.mode("overwrite").parquet(f"{root}/bronze/{feed}/{month}/")


def trip(hour, total=17.3, pu=1):
    return (1, datetime(2023, 3, 15, hour), datetime(2023, 3, 15, hour, 30), 2, 3.5, 1, "N", pu, 200, 1, 14.0,
            0.5, 0.5, 2.0, 0.0, 0.3, total, 2.5)


def test_monthly_run_twice_gives_the_same_tables(spark, tmp_path):
    root = str(tmp_path)
    bronze(spark, root, "yellow", "tpep", [trip(8), trip(8), trip(9), trip(10, total=-1.0)])
    bronze(spark, root, "green", "lpep", [trip(8, pu=2), trip(8, pu=77)])
    zones = spark.createDataFrame(
        [(1, "Manhattan", "Midtown", "Yellow Zone"), (2, "Queens", "JFK Airport", "Airports")],
        readers.ZONE_SCHEMA)
    first = monthly.run_month(spark, root, 2023, 3, zones)
    assert (first.clean, first.enriched, first.kpi) == ({"yellow": 2, "green": 2}, 4, 4)
    assert monthly.run_month(spark, root, 2023, 3, zones) == first
    kpi = readers.read_evolved(spark, f"{root}/gold/hourly_kpis")
    assert {(r.pickup_borough, r.pickup_hour, r.trip_count, r.airport_trips) for r in kpi.collect()} == {
        ("Manhattan", 8, 1, 0), ("Manhattan", 9, 1, 0), ("Queens", 8, 1, 1), (None, 8, 1, None)}
    silver = readers.read_evolved(spark, f"{root}/silver/yellow")
    assert silver.where("airport_fee = 1.25").count() == 2


def test_mart_refresh_rewrites_recent_days_only(spark, sf, tmp_path):
    path = str(tmp_path / "mart")
    feeds = catalogue.typed(spark, sf)
    newest = incremental.latest_day(warehouse.staged(feeds), "pickup_date")
    schema = marts.fact_trips(warehouse.staged(feeds).withColumn("trip_id", F.lit(""))).schema
    recent = f"pickup_datetime >= date_sub(date '{newest}', 40)"
    few = {f: df.where(recent) for f, df in feeds.items()}
    warehouse.refresh_fact(few, path, full=True, contract=schema)
    before = {r.trip_id: r.total_amount for r in spark.read.schema(schema).parquet(path).collect()}
    dearer = {f: df.withColumn("total_amount", F.col("total_amount") + 1) for f, df in few.items()}
    warehouse.refresh_fact(dearer, path, contract=schema)
    rows = spark.read.schema(schema).parquet(path).collect()
    assert len(rows) == len(before) and {r.trip_id for r in rows} == set(before)
    first = newest - timedelta(days=3)
    assert all(r.total_amount == before[r.trip_id] + (r.pickup_date >= first) for r in rows)
    assert any(r.pickup_date < first for r in rows)
    warehouse.refresh_fact({f: df.limit(0) for f, df in few.items()}, path, contract=schema)
    assert spark.read.schema(schema).parquet(path).count() == len(before)


def test_refreshed_fact_equals_the_lazy_one_and_lies_in_one_file_a_day(spark, sf, tmp_path):
    feeds = catalogue.typed(spark, sf)
    want = warehouse.fact(feeds)
    warehouse.refresh_fact(feeds, str(tmp_path), full=True, contract=want.schema)
    got = spark.read.schema(want.schema).parquet(str(tmp_path)).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert max(len(list(day.glob("*.parquet"))) for day in tmp_path.glob("pickup_date=*")) == 1


def test_join_of_lines_holds_the_rows_of_a_task(spark, sf, monkeypatch):
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 700)
    plan = catalogue.both(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey#" in plan and f", {-(-adapter.table(spark, sf, 'lineitem').count() // 700)})" in plan


def test_orders_are_not_broadcast_where_one_column_is_read(spark, sf):
    plan = catalogue.union_evolved(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan and "Broadcast" not in plan


def test_look_back_reaches_the_scan_below_the_window(spark, sf, tmp_path):
    for feed, df in catalogue.typed(spark, sf).items():
        df.write.parquet(f"{tmp_path}/{feed}")
    feeds = {f: spark.read.parquet(f"{tmp_path}/{f}") for f in ("yellow", "green")}
    trips = incremental.since(warehouse.staged(feeds), "pickup_at", "1998-07-01")
    limit = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "5000")
    try:
        plan = trips._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert plan.count("GreaterThanOrEqual(pickup_datetime") == 2


def test_shared_folder_is_stable(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_landing_runs_each_new_month_once(spark, tmp_path):
    root, seen = str(tmp_path), []
    bronze(spark, root, "yellow", "tpep", [trip(8)])
    spark.read.parquet(f"{root}/bronze/yellow/2023-03/").write.parquet(f"{root}/bronze/yellow/2023-04/")

    def handle(*month):
        seen.append(month)

    follow = lambda: landing.follow_feed(spark, root, "yellow", f"{root}/seen", handle)
    assert follow() == 2 and seen == [("yellow", 2023, 3), ("yellow", 2023, 4)]
    assert follow() == 0
    spark.read.parquet(f"{root}/bronze/yellow/2023-03/").write.mode("append").parquet(
        f"{root}/bronze/yellow/2023-03/")
    assert follow() == 1 and seen[-1] == ("yellow", 2023, 3)


def test_quality_run_sets_bad_partitions_aside(spark, tmp_path):
    root = str(tmp_path)
    bronze(spark, root, "yellow", "tpep", [trip(8), trip(9)])
    bronze(spark, root, "green", "lpep", [trip(8, pu=2)])
    zones = spark.createDataFrame([(1, "Manhattan", "Midtown", "Yellow Zone")], readers.ZONE_SCHEMA)
    monthly.run_month(spark, root, 2023, 3, zones)
    fact = readers.read_month(spark, f"{root}/gold/fact_trips", 2023, 3)
    keys = ["pickup_year", "pickup_month"]
    bad = checking.check_partition(fact, "2023-03", keys, f"{root}/reports", f"{root}/aside")
    assert (bad.passed, bad.critical) == (False, ("CHK-001",))
    assert readers.read_evolved(spark, f"{root}/aside").count() == fact.count() == 3
    assert spark.read.json(f"{root}/reports").count() == 8
    good = checking.check_partition(fact, "2023-03", keys, f"{root}/reports", f"{root}/other", TRIP_SUITE[1:])
    assert good.passed and not readers.path_exists(spark, f"{root}/other")
    none = checking.check_partition(fact.limit(0), "2023-03", keys, f"{root}/reports", f"{root}/other")
    assert not none.passed


def test_bad_feed_is_copied_aside(spark, tmp_path):
    root = str(tmp_path)
    bronze(spark, root, "yellow", "tpep", [trip(8)] * 100)
    raw = readers.read_feed(spark, root, "yellow", 2023, 3)
    assert checking.admit_feed(raw, "yellow", f"{root}/aside") == []
    assert not readers.path_exists(spark, f"{root}/aside")
    assert checking.admit_feed(raw.drop("fare_amount").limit(5), "yellow", f"{root}/aside") == [
        "missing_column: fare_amount", "too_few_rows"]
    assert spark.read.parquet(f"{root}/aside").count() == 5


def test_rolling_week_may_reach_into_the_month_before(spark, tmp_path):
    root = str(tmp_path)
    zones = spark.createDataFrame([(1, "Manhattan", "Midtown", "Yellow Zone")], readers.ZONE_SCHEMA)

    def land(month, day, copies):
        at = datetime(2023, month, day, 8)
        rows = [trip(8)[:1] + (at + timedelta(seconds=i), at + timedelta(minutes=30, seconds=i)) + trip(8)[3:]
                for i in range(copies)]
        bronze(spark, root, "yellow", "tpep", rows, f"2023-{month:02d}")
        bronze(spark, root, "green", "lpep", rows[:0], f"2023-{month:02d}")

    land(3, 20, 9)
    monthly.run_month(spark, root, 2023, 3, zones)
    land(3, 28, 4)
    monthly.run_month(spark, root, 2023, 3, zones)
    land(4, 1, 2)
    got = {}
    for carry in (False, True):
        monthly.run_month(spark, root, 2023, 4, zones, carry_week=carry)
        rows = readers.read_month(spark, f"{root}/gold/hourly_kpis", 2023, 4).collect()
        got[carry] = [(r.trip_count, r.rolling_7d_trips) for r in rows]
    assert got == {False: [(2, 2.0)], True: [(2, 3.0)]}
