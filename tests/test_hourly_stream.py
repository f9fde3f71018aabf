from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.streaming import hourly

START = datetime(2024, 1, 1)
SCHEMA = "id long, kind string, at timestamp_ntz, v double"


def land(spark, root, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def at(hours):
    return START + timedelta(hours=hours)


def test_hours_close_late_rows_are_counted_and_runs_go_on(spark, tmp_path):
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = hourly.hourly_measures(hourly.follow_table(spark, root, schema), "at", ["kind"], "v", "2 hours")
        return hourly.run_into(stream, out, check, state_partitions=2)

    def closed():
        return sorted((r.hour_start.hour, r.kind or "", r.events, r.total) for r in spark.read.parquet(out).collect())

    land(spark, root, "a", [(1, "x", at(0.5), 1.0), (2, "x", at(0.1), 2.0), (3, None, at(0.9), None), (4, "x", None, 9.0),
                            (5, "y", at(1.5), float("nan")), (6, "x", at(3.2), 5.0)])
    counts = run()
    assert closed() == [(0, "", 1, None), (0, "x", 2, 3.0)] and counts.rows == 6 and counts.dropped == 0
    assert counts.open_keys == 2
    # One row for a closed hour, one for an open one.
    land(spark, root, "b", [(7, "x", at(0.2), 100.0), (8, "y", at(1.6), 4.0)])
    land(spark, root, "c", [(9, "x", at(9.0), 1.0)])
    counts = run()
    assert counts.dropped == 1
    assert closed() == [(0, "", 1, None), (0, "x", 2, 3.0), (1, "y", 2, 4.0), (3, "x", 1, 5.0)]
    assert run().rows == 0 and len(closed()) == 4


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    from curbline.sources.sinks import insert_overwrite

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2.0)], "id int, v double")
    for _ in range(2):
        insert_overwrite(rows.withColumn(hourly.BATCH, F.lit(4)), path, [hourly.BATCH], contract=rows.schema)
    assert spark.read.parquet(path).count() == 1


def test_copies_in_different_files_give_one_row_and_state_is_bounded(spark, tmp_path):
    root, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = hourly.without_repeats(hourly.follow_table(spark, root, schema), "at", ["id"], "2 hours")
        return hourly.run_into(stream, out, check, state_partitions=2)

    land(spark, root, "a", [(1, "x", at(0), 1.0), (2, "x", at(0.5), 2.0), (1, "x", at(0), 1.0)])
    land(spark, root, "b", [(1, "x", at(0.2), 1.0), (3, "x", at(1), 3.0), (None, "x", at(1), 4.0)])
    run()
    assert sorted(str(r.id) for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "None"]
    land(spark, root, "c", [(4, "x", at(50), 1.0)])
    run()
    land(spark, root, "d", [(4, "x", at(50), 1.0)])
    counts = run()
    assert counts.open_keys == 1 and spark.read.parquet(out).count() == 5


@pytest.mark.parametrize("ts", ["at"])
def test_batch_frames_take_the_same_function(spark, ts):
    rows = spark.createDataFrame([(1, "x", at(0.5), 1.0), (2, "x", at(0.1), 2.0)], SCHEMA)
    got = hourly.hourly_measures(rows, ts, ["kind"], "v", "1 hour").collect()
    assert [(r.kind, r.events, r.total) for r in got] == [("x", 2, 3.0)]
