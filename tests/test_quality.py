from datetime import date, datetime

import pytest

from curbline.operators import quality as q
from curbline.operators.quality import Check


def results(df, *checks):
    return {r.check_id: r for r in q.run_suite(df, checks).collect()}


def test_mostly_ignores_nulls(spark):
    df = spark.createDataFrame([(1,)] * 99 + [(300,)] + [(None,)] * 50, "z int")
    got = results(df, Check("a", "between", "z", 1, 265, mostly=0.99), Check("b", "between", "z", 1, 265),
                  Check("c", "not_null", "z"))
    assert got["a"].success and got["a"].unexpected_count == 1 and got["a"].unexpected_percent == 1.0
    assert not got["b"].success
    assert not got["c"].success and got["c"].unexpected_count == 50


def test_all_null_column_passes_and_empty_frame_is_stopped(spark):
    df = spark.createDataFrame([(None, None)] * 3, "z int, c string")
    got = results(df, Check("a", "between", "z", 1, 2, mostly=0.5), Check("b", "in_set", "c", values=("x",)),
                  Check("m", "mean_between", "z", 1, 2))
    assert got["a"].success and got["b"].success and not got["m"].success
    none = q.run_suite(df.limit(0), [Check("a", "between", "z", 1, 2)])
    assert q.gate_decision(none).first().decision == "quarantine"


@pytest.mark.parametrize("n,ok", [(999, False), (1000, True)])
def test_row_count(spark, n, ok):
    assert results(spark.range(n), Check("r", "row_count", low=1000, high=5000000))["r"].success is ok


def test_severity_decides(spark):
    df = spark.createDataFrame([(1, "red")], "z int, cab string")
    warn = q.run_suite(df, [Check("w", "in_set", "cab", values=("yellow",), severity=q.WARNING, metric="bad_cab")])
    assert q.gate_decision(warn).first().decision == "pass"
    metric = q.warning_metrics(warn, [Check("w", "in_set", "cab", metric="bad_cab")], "dev", "p",
                               datetime(2023, 1, 1)).first()
    assert (metric.metric_name, metric.value) == ("bad_cab", 100.0)
    hard = q.run_suite(df, [Check("h", "between", "z", 5, 6)])
    both = q.summary(q.union_results([warn, hard])).first()
    assert (both.total, both.failed, both.critical_failures, both.warnings) == (2, 2, "h", "w")


def test_month_and_day(spark):
    df = spark.createDataFrame([(date(2023, 3, 31),), (date(2023, 4, 1),)], "pickup_date date")
    got = results(df, Check("m", "in_month", "pickup_date", month=date(2023, 3, 1)))
    assert got["m"].unexpected_count == 1
    assert q.one_day(df, "2023-04-01").count() == 1


def test_unique_and_reference_on_a_hot_key(spark):
    child = spark.createDataFrame([(7,)] * 500 + [(i,) for i in range(5)] + [(None,)], "k int")
    got = q.check_unique(child, ["k"], "u").first()
    assert (got.success, got.unexpected_count, got.element_count) == (False, 500, 505)
    parent = spark.createDataFrame([(i,) for i in range(5)] * 2, "id int")
    got = q.check_reference(child, "k", parent, "id", "f").first()
    assert (got.success, got.unexpected_count, got.element_count) == (False, 500, 505)
    assert [tuple(r) for r in q.duplicate_keys(child, ["k"]).collect()] == [(7, 500)]


@pytest.mark.parametrize("small", [True, False])
def test_references_to_a_small_and_a_large_parent(spark, monkeypatch, small):
    monkeypatch.setattr(q, "small_enough", lambda keys: small)
    monkeypatch.setitem(q.MART_CONSTRAINTS, "child", q.TableConstraints(
        not_null=("k",), references={"k": ("parent", "id"), "j": ("parent", "id")}))
    child = spark.createDataFrame([(7, 1)] * 500 + [(i, None) for i in range(5)] + [(None, 9)], "k int, j long")
    parent = spark.createDataFrame([(i,) for i in range(5)] * 2 + [(None,)], "id int")
    got = {r.check_id: r for r in q.run_constraints("child", child, {"parent": parent}).collect()}
    assert sorted(got) == ["child.j.relationship", "child.k.not_null", "child.k.relationship"]
    k, j = got["child.k.relationship"], got["child.j.relationship"]
    assert (k.check_type, k.success, k.unexpected_count, k.element_count) == ("relationship", False, 500, 505)
    assert (j.success, j.unexpected_count, j.element_count, j.observed_value) == (False, 1, 501, None)
    assert got["child.k.not_null"].element_count == 506
    none = q.run_constraints("child", child.limit(0), {"parent": parent.limit(0)}).collect()
    assert all(r.success and r.unexpected_percent is None for r in none)


def feed(spark, rows, nulls=0):
    one = "timestamp'2023-01-01' as tpep_pickup_datetime, timestamp'2023-01-01' as tpep_dropoff_datetime, " \
          "1 as trip_distance, 1 as PULocationID, 1 as DOLocationID, 1 as fare_amount, 1 as total_amount, " \
          f"1 as payment_type, case when id >= {nulls} then 1 end as passenger_count"
    return spark.range(rows).selectExpr(*one.split(", "))


def test_file_contract(spark):
    assert q.file_contract(feed(spark, 100), "yellow").isEmpty()
    assert q.contract_status(q.file_contract(feed(spark, 100), "yellow")).first().status == "ok"
    few = q.file_contract(feed(spark, 99), "yellow")
    assert [r.finding for r in few.collect()] == ["too_few_rows"]
    assert q.file_contract(feed(spark, 100, 95), "yellow").isEmpty()
    empty = q.file_contract(feed(spark, 100, 96), "yellow")
    assert [(r.finding, r.column_name) for r in empty.collect()] == [("mostly_null", "passenger_count")]
    short = q.file_contract(feed(spark, 100).drop("payment_type").selectExpr("*", "1 as odd"), "yellow")
    assert {(r.finding, r.column_name, r.severity) for r in short.collect()} == {
        ("missing_column", "payment_type", "CRITICAL"), ("unexpected_column", "odd", "WARNING")}
    assert q.contract_status(short).first().status == "quarantine"
    assert [r.finding for r in q.file_contract(spark.range(1), None).collect()] == ["unknown_feed"]


@pytest.mark.parametrize("hours,status", [(25, "pass"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness(spark, hours, status):
    df = spark.sql(f"select timestamp_ntz'2023-01-10 00:00:00' - interval {hours} hours as ts")
    assert q.freshness(df, "ts", "2023-01-10 00:00:00", "s").first().status == status


def test_no_rows_is_stale(spark):
    df = spark.sql("select timestamp_ntz'2023-01-10 00:00:00' as ts").limit(0)
    assert q.freshness(df, "ts", "2023-01-10 00:00:00", "s").first().status == "error"
