"""Numbering by sorted slices, against a plain window."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from curbline.operators import marts, ordinal
from curbline.plans import warehouse
from curbline.workload import catalogue


def frame(spark):
    """A third of the rows in one key, part of them copies; NULLs among keys and values."""
    rows = [("hot", float(i % 40), i % 7, None if i % 5 == 0 else i % 3) for i in range(1500)]
    rows += [("hot", 1.0, 1, 1)] * 500
    rows += [(None, float(i % 4), i, 0) for i in range(300)]
    rows += [(f"k{i % 900}", float(i % 3), i % 2, i) for i in range(3700)]
    return spark.createDataFrame(rows, "k string, total double, tip int, rest int").repartition(6)


def counted(df):
    return Counter(tuple(r) for r in df.select("k", "total", "tip", "rest", "ordinal").collect())


@pytest.mark.parametrize("slices", [1, 5, 64])
def test_slices_equal_plain_window(spark, slices):
    df = frame(spark)
    plain = df.withColumn("ordinal", F.row_number().over(
        Window.partitionBy("k").orderBy("total", "tip", "rest")).cast("long"))
    made = ordinal.add_ordinal(df, ["k"], ["total", "tip"], slices=slices)
    assert dict(made.dtypes)["ordinal"] == "bigint"
    assert counted(made) == counted(plain)


def test_only_crowded_groups_go_by_slices(spark, monkeypatch):
    df = frame(spark)
    plain = df.withColumn("ordinal", F.row_number().over(
        Window.partitionBy("k").orderBy("total", "tip", "rest")).cast("long"))
    cut, sliced = ordinal._by_slices, []
    monkeypatch.setattr(ordinal, "_by_slices", lambda d, *a: sliced.append(d.count()) or cut(d, *a))
    whole = ordinal.add_ordinal(df, ["k"], ["total", "tip"])
    assert counted(whole) == counted(plain) and not sliced
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(ordinal, "SLICE_ROWS", 250)
    made = ordinal.add_ordinal(df, ["k"], ["total", "tip"])
    assert dict(made.dtypes)["ordinal"] == "bigint" and counted(made) == counted(plain)
    assert sliced == [2300]


def test_numbers_dealt_by_a_part_of_the_key(spark, monkeypatch):
    df = frame(spark).withColumn("first", F.substring("k", 1, 1))
    plain = df.withColumn("ordinal", F.row_number().over(
        Window.partitionBy("k").orderBy("total", "tip", "rest")).cast("long"))
    for limit, dealt in ((10_000, True), (2000, False)):
        monkeypatch.setattr(ordinal, "SLICE_ROWS", limit)
        made, told = ordinal.add_ordinal_by(df, ["k"], ["total", "tip"], "ordinal", ["first"])
        assert told == dealt and counted(made) == counted(plain)
        if dealt:
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(first") == plan.count("Exchange hashpartitioning") == 1


def test_copies_of_one_row_are_cut(spark):
    df = spark.createDataFrame([("a", 1)] * 100 + [("a", 2)] * 50, "k string, v int").repartition(3)
    out = ordinal.add_ordinal(df, ["k"], ["v"], slices=7)
    got = sorted((r.ordinal, r.v) for r in out.collect())
    assert got == [(i, 1) for i in range(1, 101)] + [(i, 2) for i in range(101, 151)]


def test_many_groups_that_span_slices(spark):
    df = spark.range(12_000).selectExpr("id % 30 as k", "id div 90 as v", "id % 3 as w")
    out = ordinal.add_ordinal(df, ["k"], ["v"], slices=64)
    bad = out.groupBy("k").agg(F.max("ordinal").alias("m"), F.count(F.lit(1)).alias("n"),
                               F.count_distinct("ordinal").alias("u")).where("m <> n or u <> n")
    assert bad.isEmpty() and out.count() == 12_000


def test_empty_frame(spark):
    assert ordinal.add_ordinal(spark.range(0).selectExpr("id as k", "id as v"), ["k"], ["v"]).count() == 0


def test_keys_stay_unique_when_one_trip_is_copied_a_third_of_the_time(spark, sf):
    staged = warehouse.staged(catalogue.typed(spark, sf))
    first = staged.orderBy(*staged.columns).limit(1)
    copies = first.selectExpr("*", "explode(sequence(1, 2000)) as _copy").drop("_copy")
    skewed = staged.unionByName(copies)
    keyed = marts.with_trip_key(skewed)
    ids = keyed.agg(F.count("trip_id").alias("n"), F.count_distinct("trip_id").alias("u")).first()
    assert ids.n == ids.u == skewed.count()
