"""Publication, mergeable state, refined quantiles, sliced windows and footers on odd rows, and their plans."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from curbline.operators import quantiles, rollups, slices
from curbline.sources import footers, publish
from curbline.workload import adapter


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- publication -------------------------------------------------------------

@pytest.fixture
def entry(spark, tmp_path, request):
    database = f"pub_{abs(hash(request.node.name)) % 10 ** 8}"
    rows = spark.createDataFrame([(1, 1.0, 2023, 1), (2, 2.0, 2023, 2)], "id int, amount double, y int, m int")
    root = str(tmp_path / "t")
    publish.create_published(spark, database, "t", root, rows.schema, {"y": "int", "m": "int"})
    publish.publish_new(rows, database, "t", root, ["y", "m"])
    yield database, root, rows
    spark.sql(f"DROP DATABASE {database} CASCADE")


def shown(spark, database):
    return sorted((r.id, r.amount, r.y, r.m) for r in spark.table(f"{database}.t").collect())


def test_readers_see_old_or_new_and_never_half(spark, entry):
    database, root, rows = entry
    before = shown(spark, database)
    batch = spark.createDataFrame([(9, 9.0, 2023, 2), (8, 8.0, 2023, 2)], rows.schema)
    planned = spark.table(f"{database}.t").where("m = 2")
    planned_files = planned.inputFiles()
    place = publish.write_version(batch, root, ["y", "m"])           # the batch ends here, before it is shown
    assert shown(spark, database) == before
    publish.show_partition(spark, database, "t", {"y": 2023, "m": 2}, place)
    assert shown(spark, database) == [(1, 1.0, 2023, 1), (8, 8.0, 2023, 2), (9, 9.0, 2023, 2)]
    assert not set(planned_files) & set(publish.current_files(spark, database, "t"))
    assert [r.id for r in spark.read.parquet(*planned_files).collect()] == [2]  # a query planned before can still end


def test_batch_that_fails_while_writing_leaves_readers_alone(spark, entry):
    database, root, rows = entry
    before, files = shown(spark, database), publish.current_files(spark, database, "t")
    stray = spark.createDataFrame([(3, 3.0, 2023, 2), (4, 4.0, 2023, 3)], rows.schema)
    with pytest.raises(Exception, match="row outside m=2"):
        publish.publish_partition(stray, database, "t", root, {"y": 2023, "m": 2}, rows.schema)
    assert shown(spark, database) == before and publish.current_files(spark, database, "t") == files


def test_publishing_twice_and_nothing(spark, entry):
    database, root, rows = entry
    batch = spark.createDataFrame([(9, 9.0, 2023, 2)], rows.schema)
    first = publish.publish_partition(batch, database, "t", root, {"y": 2023, "m": 2}, rows.schema)
    publish.publish_partition(batch, database, "t", root, {"y": 2023, "m": 2}, rows.schema)
    assert shown(spark, database) == [(1, 1.0, 2023, 1), (9, 9.0, 2023, 2)]
    assert publish.stale_versions(spark, database, "t", root) == [first]
    publish.publish_partition(batch.limit(0), database, "t", root, {"y": 2023, "m": 2}, rows.schema)
    assert shown(spark, database) == [(1, 1.0, 2023, 1)]
    assert publish.publish_new(batch.limit(0), database, "t", root, ["y", "m"])
    with pytest.raises(AnalysisException):
        publish.publish_new(spark.createDataFrame([(1, 1.0, 2023, 1)], rows.schema), database, "t", root, ["y", "m"])
    assert shown(spark, database) == [(1, 1.0, 2023, 1)]


# ---- mergeable state ---------------------------------------------------------

def test_state_of_odd_rows(spark):
    rows = [("a", "x", 1.0, 5), ("a", "x", 3.0, 5), ("a", "y", 2.0, -7), ("a", "y", None, None), ("b", "x", None, None),
            (None, "x", 4.0, 40_000), (None, "y", 4.0, 5), ("c", "x", 1.5, None), ("a", "x", 2.5, 32_768), ("a", "z", 9.0, 0)]
    df = spark.createDataFrame(rows, "k string, f string, v double, i long")
    state = rollups.mergeable_state(df, ["k", "f"], "v", "i")
    got = {r.k: (r.row_count, r.unique_count, r.measured, r.median) for r in rollups.roll_up(state, ["k"]).collect()}
    assert got == {"a": (6, 4, 5, 2.5), "b": (1, 0, 0, None), None: (2, 2, 2, 4.0), "c": (1, 0, 1, 1.5)}
    again = rollups.roll_up(rollups.merge_state(state, ["k"]), [])
    assert [tuple(r)[:3] for r in again.collect()] == [(10, 5, 8)]
    assert rollups.roll_up(rollups.mergeable_state(df.limit(0), ["k"], "v", "i"), ["k"]).count() == 0


def test_merged_medians_keep_the_rank_error_on_large_groups(spark):
    df = spark.range(60_000).selectExpr("id % 3 as g", "id % 40 as fine", "pow(hash(id) % 1000003, 3) as v", "id as i")
    medians = rollups.roll_up(rollups.mergeable_state(df, ["g", "fine"], "v", "i"), ["g"])
    assert {r.measured for r in medians.collect()} == {20_000}
    assert [r.unique_count for r in medians.collect()] == [20_000] * 3
    for r in rollups.rank_range(df, ["g"], "v", medians).collect():
        assert r.below <= 0.5 + rollups.RANK_ERROR and r.upto >= 0.5 - rollups.RANK_ERROR


def test_roll_up_reads_the_state_only(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 as k", "id % 50 as f", "id * 1.0D as v", "id as i")
    rollups.mergeable_state(df, ["k", "f"], "v", "i").write.parquet(str(tmp_path / "s"))
    plan = physical(rollups.roll_up(spark.read.parquet(str(tmp_path / "s")), ["k"]))
    assert "bitmap_or_agg" in plan and "kll_merge_agg_double" in plan and plan.index("partial_") > 0
    assert "distinct" not in plan and "ReadSchema: struct<k:bigint,bucket:bigint,rows:bigint,sketch:binary,bitmap:binary>" in plan


# ---- quantiles ---------------------------------------------------------------

def plain_quantile(values, q):
    v = sorted(values)
    return v[min(int(len(v) * q), len(v) - 1)]


@pytest.mark.parametrize("buckets", [2, 7, 512])
def test_quantiles_of_odd_values(spark, buckets):
    pick = random.Random(1)
    groups = {
        "even": [pick.random() for _ in range(500)], "one": [3.0], "same": [2.5] * 9, None: [1.0, 2.0],
        "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1e-300, 1e300], "tiny": [0.0, 5e-324, 0.0],
        "steep": [10.0 ** i for i in range(-40, 40)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rows += [("even", None), ("even", float("nan")), ("even", float("inf")), ("none", None), ("none", float("-inf"))]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    few = df if buckets > 2 else df.where("k is null or k not in ('wide', 'steep', 'tiny')")
    got = {r.k: tuple(r)[1:] for r in quantiles.exact_quantiles(few, ["k"], "v", wanted, buckets).collect()}
    want = {k: tuple(plain_quantile(vs, q) for q in wanted.values()) for k, vs in groups.items()}
    assert got == {k: v for k, v in want.items() if buckets > 2 or k not in ("wide", "steep", "tiny")}


def test_quantiles_without_groups_or_rows(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (2.0,)], "v double")
    assert quantiles.exact_quantiles(df, [], "v", {"m": 0.5}).first().m == 2.0
    assert quantiles.exact_quantiles(df.limit(0), [], "v", {"m": 0.5}).first().m is None
    grouped = df.limit(0).withColumn("k", F.lit(1))
    assert quantiles.exact_quantiles(grouped, ["k"], "v", {"m": 0.5}).count() == 0


def test_a_pass_counts_before_the_shuffle_and_windows_see_buckets(spark, sf):
    lines = adapter.table(spark, sf, "lineitem")
    ranges = spark.createDataFrame([("R", "p50", 900.0, 90000.0, 100), ("A", "p50", 900.0, 90000.0, 7)],
                                   "l_returnflag string, quantile string, low double, high double, rank long")
    plan = physical(quantiles.refined(lines, ranges, ["l_returnflag"], "l_extendedprice", 64))
    assert "BroadcastHashJoin" in plan
    # Read upwards: the window, the final aggregate, the shuffle, the partial one.
    window, partial = plan.index("Window "), plan.index("partial_count")
    assert window < plan.index("Exchange") < partial and "HashAggregate" in plan[window:partial]
    passes = quantiles.refined(lines, ranges, ["l_returnflag"], "l_extendedprice", 64)
    assert passes.count() == 2


# ---- sliced windows ----------------------------------------------------------

def plain_means(rows, seconds):
    out = {}
    for i, k, t, _ in rows:
        own = [v for _, j, u, v in rows if t is not None and u is not None and j == k and v is not None
               and t - timedelta(seconds=seconds) <= u <= t]
        out.setdefault(i, []).append(sum(own) / len(own) if own else None)
    return {i: sorted(v, key=str) for i, v in out.items()}


@pytest.mark.parametrize("slice_seconds", [None, 7, 60, 100_000])
def test_sliced_means_of_odd_rows(spark, slice_seconds):
    pick = random.Random(2)
    start = datetime(1969, 12, 31, 23, 58)
    rows = [(i, pick.choice(["a", "b"]), start + timedelta(microseconds=pick.randrange(400_000_000)), float(pick.randrange(9)))
            for i in range(200)]
    rows += [(200, "a", None, 1.0), (201, None, start, 2.0), (202, None, start + timedelta(seconds=60), 4.0),
             (203, None, start + timedelta(seconds=60, microseconds=1), None), (1, *rows[1][1:]),
             (204, "c", start, 1.0), (205, "c", start + timedelta(seconds=120), 1e15)]
    df = spark.createDataFrame(rows, "i int, k string, t timestamp_ntz, v double")
    rolled = slices.sliced_rolling_mean(df, ["k"], "t", "v", "mean", 60, slice_seconds)
    assert rolled.columns == ["i", "k", "t", "v", "mean"]
    got = {}
    for r in rolled.collect():
        got.setdefault(r.i, []).append(r["mean"])
    want = plain_means(rows, 60)
    assert got.keys() == want.keys()
    for i, means in want.items():
        assert sorted(got[i], key=str) == pytest.approx(means) if None not in means else got[i] == means


def test_a_hot_key_is_spread_over_slices(spark):
    df = spark.range(10_000).selectExpr("id div 100000 as k", "timestamp_seconds(id) as t", "1.0D as v")
    rolled = slices.sliced_rolling_mean(df, ["k"], "t", "v", "mean", 60)
    assert "hashpartitioning(k" in physical(rolled) and "_slice" in physical(rolled)
    per_slice = df.selectExpr("floor(unix_micros(t) / 60000000D) as s").groupBy("s").count().agg(F.max("count")).first()[0]
    assert per_slice <= 60 and rolled.count() == 10_000


def test_the_work_of_a_row_does_not_grow_with_its_window(spark):
    """120,000 rows of one key in one window: 7.2 billion steps where every row adds up its window again."""
    df = spark.range(120_000).selectExpr("1 as k", "timestamp_millis(id) as t", "cast(id % 7 as double) as v")
    began = time.monotonic()
    rolled = slices.sliced_rolling_mean(df, ["k"], "t", "v", "mean", 3600)
    got = rolled.agg(F.count("mean").alias("n"), F.max_by("mean", "t").alias("last")).first()
    assert time.monotonic() - began < 60
    assert got.n == 120_000 and got["last"] == pytest.approx(sum(i % 7 for i in range(120_000)) / 120_000, abs=1e-12)


def test_sliced_means_of_values_beyond_the_accumulator(spark):
    values = [1.0, float("nan"), 2.0, float("inf"), 3.0, -float("inf"), 4.0, 1e300, 5.0, 9e25, 9e25, None, 6.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").selectExpr(
        "i", "timestamp_seconds(i * 40) as t", "v")
    for seconds in (20, 60, 100):
        got = {r.i: r["mean"] for r in slices.sliced_rolling_mean(df, [], "t", "v", "mean", seconds).collect()}
        for i in range(len(values)):
            own = [v for j, v in enumerate(values[:i + 1]) if (i - j) * 40 <= seconds and v is not None]
            assert got[i] == (pytest.approx(sum(own) / len(own), nan_ok=True) if own else None)


# ---- footers -----------------------------------------------------------------

def test_footers_answer_without_reading_columns(spark, sf):
    plan = footers.footer_plan(spark, f"{sf}/lineitem.parquet", ["l_orderkey"])
    assert "PushedAggregation: [COUNT(*), COUNT(l_orderkey), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert footers.footer_rows(spark, f"{sf}/lineitem.parquet") == adapter.table(spark, sf, "lineitem").count()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_footers_of_odd_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x", True), (None, None, None, False), (-3, None, "y", None)],
                               "a int, b double, c string, d boolean")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    got = {r.column_name: tuple(r)[1:] for r in footers.footer_profile(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": (3, 1, "-3", "1"), "b": (3, 3, None, None), "c": (3, 1, None, None), "d": (3, 1, "false", "true")}
    df.limit(0).write.parquet(str(tmp_path / "none"))
    assert footers.footer_rows(spark, str(tmp_path / "none")) == 0
