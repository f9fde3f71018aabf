"""Physical plans: what must be pushed down, pruned, pre-aggregated or broadcast."""

import re

import pytest

import __spark_entry__ as entry
from curbline.operators import clean, kpi
from curbline.operators.joins import orphans
from curbline.workload import adapter, catalogue


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "clean_trips", "kpi_rolling_7d", "union_keyed", "mart_hourly_obt", "dq_suite", "serve_top_pickup_zones",
    "score_summary",
])
def test_no_python_in_any_plan(spark, sf, name):
    plan = physical(entry.queries()[name](spark, sf))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dedup_limits_groups_before_the_shuffle(spark, sf):
    lines = adapter.table(spark, sf, "lineitem")
    plan = physical(clean.dedup(lines, ["l_orderkey"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_gates_reach_the_scan(spark, tmp_path):
    spark.sql(
        "select 1.0D as trip_distance, 2L as passenger_count, 3.0D as total_amount, 4L as PULocationID, "
        "5L as DOLocationID, timestamp_ntz'2023-01-01' as tpep_pickup_datetime, "
        "timestamp_ntz'2023-01-01' as tpep_dropoff_datetime, 'x' as never_read").write.parquet(str(tmp_path / "f"))
    raw = spark.read.parquet(str(tmp_path / "f"))
    typed = clean.month_fence(clean.enforce_types(clean.normalize_columns(raw, "yellow")), 2023, 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = physical(clean.gate(typed, clean.quality_rules()).select("trip_distance"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for part in ("GreaterThan(trip_distance,0.0)", "LessThan(total_amount,5000.0)",
                 "GreaterThanOrEqual(tpep_pickup_datetime", "LessThanOrEqual(passenger_count,6)"):
        assert part in pushed
    assert "never_read" not in plan


def test_hourly_counts_are_partial_before_the_shuffle(spark, sf):
    plan = physical(kpi.hourly_kpis(catalogue.gold(spark, sf)))
    assert plan.count("HashAggregate") >= 4 and "SortAggregate" not in plan


def test_small_dimensions_are_broadcast(spark, sf):
    plan = physical(catalogue.gold(spark, sf))
    assert plan.count("BroadcastHashJoin") >= 3


def test_orphans_count_before_joining_a_large_parent(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = adapter.table(spark, sf, "lineitem")
    plan = physical(orphans(lines, "l_suppkey", adapter.table(spark, sf, "supplier"), "s_suppkey"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.index("HashAggregate")


def test_serving_queries_skip_the_surrogate_key(spark, sf):
    plan = physical(entry.queries()["serve_monthly_volume"](spark, sf))
    assert "sha2" not in plan and "row_number" not in plan
