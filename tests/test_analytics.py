import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from curbline.functions.numeric import exact_avg, exact_sum, round_to
from curbline.operators import joins, kpi, ranking
from curbline.plans import serving


def value(spark, sql):
    return spark.sql(f"select {sql} as v").first().v


@pytest.mark.parametrize("x,places,want", [
    ("2.5D", 0, 3.0), ("-2.5D", 0, -3.0), ("1.005D", 2, 1.0), ("0.125D", 2, 0.13), ("1e20D", 2, 1e20),
    ("cast(null as double)", 2, None),
])
def test_rounding(spark, x, places, want):
    assert value(spark, round_to(x, places)) == want


def test_sum_does_not_depend_on_order(spark):
    rng = random.Random(5)
    cents = [rng.randrange(1, 10**7) for _ in range(20000)]
    want = sum(cents) / 100
    for seed in (1, 2):
        rng.shuffle(cents)
        df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(seed * 3)
        assert df.selectExpr(f"{exact_sum('x')} as s").first().s == want


def test_sum_of_extremes_and_nulls(spark):
    df = spark.createDataFrame([(1e15,), (0.25,), (None,)], "x double")
    row = df.selectExpr(f"{exact_sum('x')} as s", f"{exact_avg('x')} as a").first()
    assert row.s == 1e15 + 0.25 and row.a == (1e15 + 0.25) / 2
    nothing = df.limit(0).selectExpr(f"{exact_sum('x')} as s", f"{exact_avg('x')} as a").first()
    assert nothing.s is None and nothing.a is None
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").selectExpr(f"{exact_sum('x')} as s")
    assert math.isnan(nan.first().s)


@pytest.mark.parametrize("x,rows", [(0.00004, 1000), (999_999_999.0, 20_000), (2 / 3, 3), (1e25, 40)])
def test_sums_keep_small_and_large_values(spark, x, rows):
    df = spark.range(rows).selectExpr(f"{x!r}D as x")
    row = df.selectExpr(f"{exact_sum('x')} as s", f"{exact_avg('x')} as a").first()
    assert row.s == pytest.approx(x * rows, rel=1e-11) and row.a == pytest.approx(x, rel=1e-11)


def test_rolling_window_edges(spark):
    start = datetime(2023, 1, 1)
    rows = [("a", start, 10), ("a", start + timedelta(days=7), 20), ("a", start + timedelta(days=7, seconds=1), 30),
            (None, start, 5)]
    df = spark.createDataFrame(rows, "b string, ts timestamp_ntz, n bigint")
    got = {(r.b, r.n): r.m for r in kpi.rolling_mean(df, ["b"], "ts", {"m": "n"}).collect()}
    assert got == {("a", 10): 10.0, ("a", 20): 15.0, ("a", 30): 25.0, (None, 5): 5.0}


def test_all_null_flags_sum_to_null(spark):
    df = spark.sql(
        "select date'2023-01-01' as pickup_date, 1 as pickup_hour, 'x' as pickup_borough, 1D as total_amount, "
        "1D as fare_amount, 1D as trip_distance, 1D as trip_duration_min, 0D as tip_rate, "
        "cast(null as boolean) as is_airport_trip, true as is_weekend, 5 as PULocationID")
    row = kpi.hourly_kpis(df).first()
    assert row.airport_trips is None and row.weekend_trips == 1


def test_dimension_join_keeps_rows_either_way(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1, "one")], "k bigint, name string")
    assert joins.small_enough(dim) and not joins.small_enough(dim, limit=3)
    for small in (True, False, None):
        out = joins.dim_join(fact, dim, "k", small)
        assert sorted(str(r.name) for r in out.collect()) == ["None", "None", "one", "one"]


def test_large_dimension_is_not_broadcast(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    plan = joins.dim_join(fact, spark.range(5).withColumnRenamed("id", "k"), "k", small=True)
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_nearest_rank_against_sorted_lists(spark):
    rng = random.Random(3)
    groups = defaultdict(list)
    for _ in range(3000):
        groups[rng.choice("abc")].append(rng.randrange(50))
    groups["one"].append(9)
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = ranking.nearest_rank(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()
    for r in got:
        vs = sorted(groups[r.g])
        assert r.p50 == vs[len(vs) // 2]
        assert r.p95 == vs[min(int(len(vs) * 0.95), len(vs) - 1)]


@pytest.mark.parametrize("rows,cap", [(1000, 100), (50, 100), (100, 100), (20000, 1)])
def test_sample_size(spark, rows, cap):
    got = [r.id for r in ranking.sample_capped(spark.range(rows), cap).collect()]
    assert len(got) == len(set(got)) == min(rows, cap)


def test_search(spark):
    df = spark.createDataFrame([(1, "Blue Ring"), (22, None), (3, "x")], "a int, b string")
    assert [r.a for r in ranking.search_rows(df, "ring").collect()] == [1]
    assert [r.a for r in ranking.search_rows(df, "2").collect()] == [22]
    assert ranking.search_rows(df, ".*", regex=False).isEmpty()
    assert ranking.search_rows(df, "ring|^b").count() >= 1
    assert ranking.search_rows(df, "^b", regex=True).count() == 1


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 5)], "b string, f string, trips bigint")
    got = ranking.share_of_total(df, "trips", "share", ["b"]).collect()
    assert sorted(r.share for r in got) == [0.25, 0.75, 1.0]
    flat = ranking.scale_to_unit(df.where("f = 'y'"), "trips", "s").first()
    assert flat.s == 0.0


def test_weighted_mean_is_per_trip(spark):
    df = spark.createDataFrame([("Queens", 10.0, 1), ("Bronx", 20.0, 3)],
                               "pickup_borough string, avg_fare double, trip_count bigint")
    assert serving.avg_fare_by_group(df).first().avg_fare == 15.0
    assert serving.avg_fare_by_group(df, weighted=True).first().avg_fare == 17.5


def test_answer_scores(spark):
    df = spark.createDataFrame([("Credit CARD and cash, 40 percent",), ("error: none",), (None,)], "text string")
    got = {(r.text, r.case_id): r for r in serving.score_answers(df, "text").collect()}
    assert got[("Credit CARD and cash, 40 percent", "payment_type_share")].passed
    bad = got[("error: none", "empty_result_graceful")]
    assert bad.forbidden_hit and not bad.passed and bad.precision == pytest.approx(2 / 6)
    assert got[(None, "hourly_pattern")].precision == 0.0


def test_filters(spark):
    df = spark.createDataFrame(
        [(date(2023, 1, 1), "yellow", "Manhattan"), (date(2023, 12, 31), "green", None)],
        "pickup_date date, cab_type string, borough_group string")
    assert serving.filtered(df).count() == 2
    assert serving.in_year(df, 2023).count() == 2
    assert serving.filtered(df, feeds=["green"]).count() == 1
    assert serving.filtered(df, boroughs=["Manhattan"], end="2023-01-01").count() == 1
    assert serving.filtered(df, "2024-01-01").count() == 0
