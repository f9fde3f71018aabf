"""Bucketed tables, calendar pruning, suites as data and answers of one case, on odd rows, and their plans."""

import json
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.operators import marts, suites
from curbline.operators import quality as q
from curbline.operators.joins import on_days
from curbline.plans import serving
from curbline.sources import bucketed, sinks, spines
from curbline.workload import mechanisms


def executed(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan


# ---- buckets -----------------------------------------------------------------

@pytest.mark.parametrize("buckets", [4, 8])
def test_join_and_reference_check_have_no_exchange(spark, sf, buckets):
    lines, orders = mechanisms.bucketed_pair(spark, sf, buckets, urgent=False)
    joined = bucketed.bucket_join(lines, orders, "l_orderkey")
    missing = bucketed.bucket_orphans(lines, "l_orderkey", orders, "l_orderkey")
    for df in (joined, missing):
        plan = executed(df).toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    total = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert joined.count() + missing.agg(F.sum("row_count")).first()[0] == total


def test_null_keys_repeats_and_nothing(spark, tmp_path):
    database = f"b_{uuid.uuid4().hex}"
    child = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (3, 4), (9, 5)], "k long, v int")
    parent = spark.createDataFrame([(3, "x"), (None, "y")], "k long, v string")
    bucketed.write_bucketed(child, database, "c", str(tmp_path / "c"), ["k"], 4)
    bucketed.write_bucketed(parent, database, "p", str(tmp_path / "p"), ["k"], 4)
    bucketed.write_bucketed(parent.limit(0), database, "e", str(tmp_path / "e"), ["k"], 4)
    c, p, e = (bucketed.open_bucketed(spark, database, n, uneven=9) for n in "cpe")
    assert sorted(tuple(r) for r in bucketed.bucket_orphans(c, "k", p, "k").collect()) == [(9, 1)]
    assert sorted(tuple(r) for r in bucketed.bucket_orphans(c, "k", e, "k").collect()) == [(3, 2), (9, 1)]
    assert bucketed.bucket_join(c, p.withColumnRenamed("v", "w"), "k").count() == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_hot_key_is_opened_without_its_buckets(spark, tmp_path):
    database = f"b_{uuid.uuid4().hex}"
    hot = spark.range(4000).selectExpr("case when id % 3 = 0 then 7L else id end as k")
    share = bucketed.write_bucketed(hot, database, "hot", str(tmp_path / "hot"), ["k"], 16)
    assert share > 5
    assert "Bucketed: true" not in executed(bucketed.open_bucketed(spark, database, "hot")).toString()
    assert bucketed.open_bucketed(spark, database, "hot").count() == 4000
    even = bucketed.write_bucketed(spark.range(4000).toDF("k"), database, "even", str(tmp_path / "even"), ["k"], 16)
    assert 1 <= even < 2
    plan = executed(bucketed.open_bucketed(spark, database, "even").groupBy("k").count()).toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.mark.parametrize("size,want", [(0, 1), (1, 1), (100, 1), (101, 2), (250, 4), (400, 4), (401, 8)])
def test_bucket_count(size, want):
    assert bucketed.bucket_count(size, 100) == want


# ---- calendar ----------------------------------------------------------------

def scanned_files(df):
    """Files that the scan of the fact opened, after the query has run."""
    def scans(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from scans(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from scans(plan.plan())
        elif kind == "FileSourceScanExec":
            yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from scans(children.apply(i))
    # No scan is left where the chosen days turn out to be none.
    return sum(s.metrics().apply("numFiles").value() for s in scans(df._jdf.queryExecution().executedPlan()))


def test_only_the_chosen_days_are_opened(spark, tmp_path):
    days = [date(2023, 6, 1) + timedelta(days=i) for i in range(60)]
    rows = [(d, i) for i, d in enumerate(days)] + [(None, 99)]
    path = str(tmp_path / "fact")
    sinks.write_partitioned(spark.createDataFrame(rows, "pickup_date date, v int"), path, ["pickup_date"])
    fact = spark.read.schema("v int, pickup_date date").parquet(path)
    calendar = marts.dim_datetime(spines.date_spine(spark, days[0], days[-1]))
    for condition, want in (("quarter = 3", [i for i, d in enumerate(days) if d.month >= 7]),
                            ("is_weekend", [i for i, d in enumerate(days) if d.weekday() >= 5]),
                            ("is_us_holiday", [33]), ("is_us_holiday or day_of_month = 2", [1, 31, 33]),
                            ("quarter = 1", [])):
        got = on_days(fact, calendar, condition)
        assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.v for r in got.collect()) == want
        assert scanned_files(got) == len(want)


# ---- suites as data ----------------------------------------------------------

def test_shipped_suite_is_the_declared_one(spark):
    assert suites.shipped_suite(spark) == q.TRIP_SUITE


def test_suite_from_a_file_runs(spark, tmp_path):
    text = json.dumps({"suite": "s", "checks": [
        {"check_id": "a", "kind": "in_set", "column": "n", "values": ["1", "2"], "mostly": 0.5},
        {"check_id": "b", "kind": "in_month", "column": "d", "month": "2023-03-01", "severity": "WARNING", "metric": "m"},
        {"check_id": "c", "kind": "row_count", "high": 2}]}, indent=1)
    (tmp_path / "s.json").write_text(text)
    checks = suites.read_suite(spark, str(tmp_path / "s.json"))
    assert checks[1] == q.Check("b", "in_month", "d", severity=q.WARNING, metric="m", month=date(2023, 3, 1))
    rows = spark.createDataFrame([(1, date(2023, 3, 1)), (7, date(2023, 4, 1)), (None, None)], "n int, d date")
    got = {r.check_id: (r.success, r.unexpected_count) for r in q.run_suite(rows, checks).collect()}
    assert got == {"a": (True, 1), "b": (False, 1), "c": (False, None)}
    assert suites.missing_columns(rows.drop("d"), checks) == ["d"]


@pytest.mark.parametrize("change,named", [
    ({"kind": "betwixt"}, "unknown kind betwixt"), ({"kind": None}, "unknown kind NULL"), ({"column": None}, "no column"),
    ({"low": None, "high": None}, "kind between lacks its limits"), ({"low": "abc"}, "low is no double"),
    ({"low": 9}, "low above high"), ({"severity": "LOUD"}, "severity LOUD"), ({"mostly": 1.5}, "mostly outside 0 to 1"),
    ({"colum": "x"}, "unknown fields colum"), ({"check_id": ""}, "no check_id"),
    ({"kind": "in_set", "values": []}, "kind in_set lacks its limits"), ({"kind": "in_month"}, "kind in_month lacks its limits"),
])
def test_bad_checks_are_named(spark, change, named):
    good = {"check_id": "ok", "kind": "not_null", "column": "x"}
    bad = {"check_id": "b", "kind": "between", "column": "x", "low": 1, "high": 2} | change
    with pytest.raises(ValueError, match=named):
        suites.parse_suite(spark, json.dumps({"suite": "s", "checks": [good, bad]}))


@pytest.mark.parametrize("text", ["", "no json", "{}", '{"checks": []}', '{"checks": null}', None])
def test_texts_without_checks(spark, text):
    with pytest.raises(ValueError, match="no checks"):
        suites.parse_suite(spark, text)


def test_every_problem_is_named_at_once(spark):
    two = [{"check_id": "a", "kind": "x", "column": "c"}, {"check_id": "a", "kind": "not_null"}]
    with pytest.raises(ValueError) as e:
        suites.parse_suite(spark, json.dumps({"checks": two}))
    assert all(p in str(e.value) for p in ("check 1 (a): unknown kind x", "check 1 (a): check_id a twice", "check 2 (a): no column"))


# ---- answers of one case -----------------------------------------------------

def test_own_case_only(spark):
    cases = (("a", ("one", "two"), ()), ("b", (), ("bad",)))
    rows = [("a", "One and two"), ("a", "one"), ("b", "fine"), ("b", "BAD"), ("b", None), ("c", "one two"), (None, "one")]
    got = serving.score_answers(spark.createDataFrame(rows, "asked string, t string"), "t", cases, case="asked").collect()
    assert [(r.case_id, r.precision, r.forbidden_hit, r.passed) for r in got] == [
        ("a", 1.0, False, True), ("a", 0.5, False, False), ("b", 1.0, False, True), ("b", 1.0, True, False),
        ("b", 1.0, False, True), (None, None, False, False), (None, None, False, False)]
    named = spark.createDataFrame(rows[:2], "case_id string, t string")
    assert serving.score_answers(named, "t", cases, case="case_id").columns == ["t", "case_id", "precision", "forbidden_hit", "passed"]
