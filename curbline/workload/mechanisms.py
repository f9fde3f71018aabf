"""Queries on published versions, mergeable state, refined quantiles, sliced windows, footers, buckets and suites."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from curbline.functions.numeric import exact_sum
from curbline.operators import quality, quantiles, rollups, slices, suites
from curbline.operators.joins import on_days
from curbline.plans import pipeline, serving
from curbline.session import scratch_path
from curbline.sources import bucketed, footers, publish, readers, sinks
from curbline.streaming import hourly
from curbline.workload import adapter as ad
from curbline.workload.adapter import exact_avg_sql, exact_sum_sql, with_sql
from curbline.workload.catalogue import SUITE, _SCORED_SQL, _gold_sql, _orders_by_month, checked, days, picked, query, silver


@query("publish_month", f"""
select cast(year(o_orderdate) as integer) as o_year, cast(month(o_orderdate) as integer) as o_month, count(*) as orders,
  {exact_sum_sql("case when year(o_orderdate) = 1997 and month(o_orderdate) = 3 then o_totalprice + 100 else o_totalprice end")} as total,
  max(case when year(o_orderdate) = 1997 and month(o_orderdate) = 3 then 1 else 0 end) as version
from orders group by 1, 2""")
def publish_month(spark, sf):
    """All months published at once, then one of them again with other prices."""
    root, database = scratch_path(spark, "published"), f"lake_{uuid.uuid4().hex}"
    orders = _orders_by_month(spark, sf).withColumn("version", F.lit(0))
    keys = {"o_year": "int", "o_month": "int"}
    publish.create_published(spark, database, "orders", root, orders.schema, keys)
    publish.publish_new(orders, database, "orders", root, list(keys))
    march = orders.where("o_year = 1997 and o_month = 3").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 100, "version": F.lit(1)})
    publish.publish_partition(march, database, "orders", root, {"o_year": 1997, "o_month": 3}, orders.schema)
    return spark.table(f"{database}.orders").groupBy("o_year", "o_month").agg(
        F.count(F.lit(1)).alias("orders"), F.expr(f"{exact_sum('o_totalprice')} as total"),
        F.max("version").alias("version"))


_LEVELS = {"day": ["pickup_date"], "month": ["pickup_year", "pickup_month"], "borough": ["pickup_borough"], "all": []}


def _levels(spark, sf):
    """Per level: its keys and its rows, rolled up from the written state of day and borough."""
    trips = picked(spark, sf).select("pickup_date", "pickup_year", "pickup_month", "pickup_borough", "PULocationID",
                                     "trip_duration_min")
    path = scratch_path(spark, "trips")
    trips.write.parquet(path)
    trips = spark.read.parquet(path)
    fine = ["pickup_date", "pickup_year", "pickup_month", "pickup_borough"]
    stored = scratch_path(spark, "state")
    rollups.mergeable_state(trips, fine, "trip_duration_min", "PULocationID").write.parquet(stored)
    state = spark.read.parquet(stored)
    return trips, {level: (keys, rollups.roll_up(state, keys)) for level, keys in _LEVELS.items()}


def _place(keys):
    """The keys of a level as one text, for both engines."""
    return "concat_ws('/', '', " + ", ".join(f"coalesce(cast({k} as string), '')" for k in keys) + ")" if keys else "''"


def _levels_sql(columns, least=0):
    return _gold_sql(" union all ".join(
        f"select '{level}' as level, {_place(keys)} as place, {columns} from gold"
        + (f" group by {', '.join(keys)}" if keys else "") + f" having count(*) > {least}"
        for level, keys in _LEVELS.items()))


@query("distinct_rollup", _levels_sql("count(*) as row_count, count(distinct PULocationID) as unique_count"))
def distinct_rollup(spark, sf):
    """Zones per day, month, borough and in all, from bitmaps."""
    _, levels = _levels(spark, sf)
    made = [df.selectExpr(f"'{level}' as level", f"{_place(keys)} as place", "row_count", "unique_count")
            for level, (keys, df) in levels.items()]
    return made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3]).where("row_count > 0")


@query("median_rollup", _levels_sql("count(trip_duration_min) as measured, true as within_error"))
def median_rollup(spark, sf):
    """Median durations merged from sketches, and whether their exact ranks keep to the stated error."""
    trips, levels = _levels(spark, sf)
    made = None
    for level, (keys, df) in levels.items():
        path = scratch_path(spark, "medians")
        df.write.parquet(path)
        medians = spark.read.parquet(path)
        # A value holds all ranks between the rows below it and those up to it.
        rows = rollups.rank_range(trips, keys, "trip_duration_min", medians).selectExpr(
            f"'{level}' as level", f"{_place(keys)} as place", "measured",
            f"below <= 0.5D + greatest({rollups.RANK_ERROR}D, 1D / measured) "
            f"and upto >= 0.5D - greatest({rollups.RANK_ERROR}D, 1D / measured) as within_error")
        made = rows if made is None else made.unionByName(rows)
    return made


@query("price_quantiles", """
select l_returnflag, min(l_extendedprice) filter (where i = least(cast(floor(n * 0.5e0) as bigint), n - 1)) as p50,
  min(l_extendedprice) filter (where i = least(cast(floor(n * 0.95e0) as bigint), n - 1)) as p95,
  min(l_extendedprice) filter (where i = 0) as lowest, max(l_extendedprice) as highest
from (select l_returnflag, l_extendedprice, row_number() over (partition by l_returnflag order by l_extendedprice) - 1 as i,
    count(*) over (partition by l_returnflag) as n from lineitem)
group by l_returnflag""")
def price_quantiles(spark, sf):
    return quantiles.exact_quantiles(
        ad.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice",
        {"p50": 0.5, "p95": 0.95, "lowest": 0.0, "highest": 1.0})


@query("rolling_raw_events", f"""
select event_id, {exact_avg_sql('value', ' over w')} as day_mean
from events window w as (partition by event_type order by epoch_us(ts) range between 86400000000 preceding and current row)""")
def rolling_raw_events(spark, sf):
    """Means over the day before each event, of the events themselves."""
    events = ad.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return slices.sliced_rolling_mean(events, ["event_type"], "ts", "value", "day_mean", 86_400).select(
        "event_id", "day_mean")


_FOOTER_BOUNDS = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("footer_profile", " union all ".join(
    f"select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count, "
    + (f"cast(min({c}) as varchar) as low, cast(max({c}) as varchar) as high"
       if c in _FOOTER_BOUNDS else "cast(null as varchar) as low, cast(null as varchar) as high") + " from lineitem"
    for c in (*_FOOTER_BOUNDS, "l_returnflag", "l_shipdate")))
def footer_profile(spark, sf):
    return footers.footer_profile(spark, f"{sf}/lineitem.parquet", (*_FOOTER_BOUNDS, "l_returnflag", "l_shipdate"))


# ---- buckets, calendar pruning, suites as data -------------------------------

BUCKETS = 8


def bucketed_pair(spark, sf, buckets=BUCKETS, urgent=True):
    """Lines and orders (without the urgent ones, on request) as bucketed tables on the order's key."""
    database, path = f"lake_{uuid.uuid4().hex}", scratch_path(spark, "bucketed")
    lines = ad.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = ad.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    if not urgent:
        orders = orders.where("o_orderpriority <> '1-URGENT'")
    bucketed.write_bucketed(lines, database, "lines", f"{path}/lines", ["l_orderkey"], buckets)
    bucketed.write_bucketed(orders.withColumnRenamed("o_orderkey", "l_orderkey"), database, "orders", f"{path}/orders",
                            ["l_orderkey"], buckets)
    return bucketed.open_bucketed(spark, database, "lines"), bucketed.open_bucketed(spark, database, "orders")


@query("bucketed_join", f"""
select o_orderpriority, count(*) as n, {exact_sum_sql('l_extendedprice')} as total
from lineitem join orders on l_orderkey = o_orderkey group by all""")
def bucketed_join(spark, sf):
    """Two large tables joined bucket by bucket, then summed."""
    lines, orders = bucketed_pair(spark, sf)
    return bucketed.bucket_join(lines, orders, "l_orderkey").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"{exact_sum('l_extendedprice')} as total"))


@query("bucketed_reference", """
select l_orderkey, count(*) as row_count from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderpriority <> '1-URGENT') group by all""")
def bucketed_reference(spark, sf):
    """Lines without an order among the orders that are not urgent, per key."""
    lines, orders = bucketed_pair(spark, sf, urgent=False)
    return bucketed.bucket_orphans(lines, "l_orderkey", orders, "l_orderkey")


_CHOSEN = "quarter = 2 or is_us_holiday"


@query("calendar_days", with_sql(*ad.SANE, *ad.DAYS, final=f"""
select pickup_date, vehicle_type, count(*) as trips, {exact_sum_sql('total_amount')} as revenue
from silver join days on pickup_date = date_day where {_CHOSEN} group by all"""))
def calendar_days(spark, sf):
    """Trips on holidays and in the second quarter, from the files of those days only."""
    path = scratch_path(spark, "by-day")
    trips = silver(spark, sf).select("pickup_date", "vehicle_type", "total_amount")
    sinks.write_partitioned(trips, path, ["pickup_date"])
    fact = spark.read.schema(trips.schema).parquet(path)
    return on_days(fact, days(spark, sf), _CHOSEN).groupBy("pickup_date", "vehicle_type").agg(
        F.count(F.lit(1)).alias("trips"), F.expr(f"{exact_sum('total_amount')} as revenue"))


@query("dq_suite_from_json", with_sql(*SUITE, final="select * from suite"))
def dq_suite_from_json(spark, sf):
    return quality.run_suite(checked(spark, sf), suites.shipped_suite(spark))


_CASE_NAMES = [name for name, _, _ in serving.ANSWER_CASES]
_ASKED_SQL = "[" + ", ".join(f"'{n}'" for n in _CASE_NAMES) + "][(conv_id % 5) + 1]"


@query("score_own_case", with_sql(_SCORED_SQL, final=f"""
select conv_id, turn, case_id, precision, forbidden_hit, passed from scored where case_id = {_ASKED_SQL}"""))
def score_own_case(spark, sf):
    """Each turn as the answer to one case, scored by that case only."""
    asked = f"element_at(array({', '.join(repr(n) for n in _CASE_NAMES)}), cast(conv_id % 5 as int) + 1)"
    turns = ad.table(spark, sf, "conversations").selectExpr("conv_id", "turn", "text", f"{asked} as asked")
    return serving.score_answers(turns, "text", case="asked").drop("text")


@query("listed_files", """
select cast(year(o_orderdate) as integer) as o_year, count(*) as rows, 0 as empty_files, true as all_sized from orders group by 1
union all select 1900, 0, 1, true""")
def listed_files(spark, sf):
    """Rows by the listed files of each partition; a file without rows is listed like any other."""
    path = scratch_path(spark, "listed")
    orders = _orders_by_month(spark, sf).drop("o_month")
    sinks.write_partitioned(orders, path, ["o_year"])
    orders.drop("o_year").limit(0).write.parquet(f"{path}/o_year=1900")
    counted = spark.read.schema(orders.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n"))
    listed = readers.file_listing(spark, path)
    return listed.join(counted, "file_path", "left").groupBy("o_year").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n").isNull()).alias("empty_files"),
        F.expr("every(bytes > 0)").alias("all_sized"))


# ---- one run over both feeds ----------------------------

_RUN = (date(1997, 3, 1), date(1997, 6, 1))
_BROKEN = date(1997, 5, 1)
_NOT_LANDED = date(1997, 6, 1)


def landed_feeds(spark, sf, root):
    """Both feeds of the run's months as they land: one feed lacks a column in May and June's has not come."""
    for feed, raw in ad.raw_feeds(spark, sf).items():
        clock = next(c for c in raw.columns if c.endswith("pickup_datetime"))
        staged = scratch_path(spark, "dealt")
        sinks.write_partitioned(
            raw.where(f"{clock} >= timestamp_ntz'{_RUN[0]}' and {clock} < timestamp_ntz'{_RUN[1]}' + interval 1 month")
            .withColumn("month", F.date_format(clock, "yyyy-MM")), staged, ["month"])
        for month in ("1997-03", "1997-04", "1997-05", "1997-06"):
            rows = spark.read.parquet(f"{staged}/month={month}")
            if feed == "green" and month == f"{_BROKEN:%Y-%m}":
                rows = rows.drop("payment_type")
            if feed == "yellow" or month != f"{_NOT_LANDED:%Y-%m}":
                rows.write.parquet(readers.raw_month_path(root, feed, *map(int, month.split("-"))))


@query("pipeline_months", with_sql(*ad.KPI, final=f"""
select month_start as month, status, coalesce(trips, 0) as trips, coalesce(hours, 0) as hours, revenue,
  coalesce(staged, 0) as staged
from (values (date '1997-03-01', 'published'), (date '1997-04-01', 'published'), (date '{_BROKEN}', 'not admitted'),
    (date '{_NOT_LANDED}', 'missing')) m(month_start, status)
left join (select date_trunc('month', pickup_date) as d, count(*) as trips, {exact_sum_sql('total_amount')} as revenue,
    count(distinct (pickup_date, pickup_hour, coalesce(pickup_borough, ''))) as hours,
    count(*) filter (where pickup_datetime < dropoff_datetime and total_amount >= 0) as staged
  from gold group by 1) g on status = 'published' and month_start = d"""))
def pipeline_months(spark, sf):
    """All pending months from landing to the catalog: what was decided, and what readers of the catalog then see.

    The suite is the declared one without its lower bound on rows, which the supplied months do not reach. Lines
    of 50 pieces have no zone by the feed's design: checks on places are reported and do not stop the month.
    """
    root, database = scratch_path(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    landed_feeds(spark, sf, root)
    checks = [replace(c, low=1) if c.kind == "row_count" else c for c in quality.TRIP_SUITE
              if c.check_id not in ("CHK-004", "CHK-004b")]
    tolerated = [f"fact_trips.{c}.relationship" for c in quality.MART_CONSTRAINTS["fact_trips"].references]
    tolerated.append("mart_hourly_kpi.borough_group.not_null")
    pipeline.run_months(spark, root, *_RUN, ad.zones(spark, sf), database, checks=checks, tolerated=tolerated, min_rows=1)
    month = "make_date(pickup_year, pickup_month, 1) as month"
    shown = spark.table(f"{database}.gold_fact_trips").selectExpr(month, "total_amount").groupBy("month").agg(
        F.count(F.lit(1)).alias("trips"), F.expr(f"{exact_sum('total_amount')} as revenue"))
    hours = spark.table(f"{database}.gold_hourly_kpis").selectExpr(month).groupBy("month").agg(
        F.count(F.lit(1)).alias("hours"))
    staged = spark.table(f"{database}.marts_fact_trips").selectExpr(month).groupBy("month").agg(
        F.count(F.lit(1)).alias("staged"))
    plan = pipeline.month_plan(spark, root, *_RUN).withColumnRenamed("month_start", "month")
    said = pipeline.run_log(spark, root).selectExpr("month", "status as said")
    out = plan.join(said, "month", "left").withColumn("status", F.coalesce("said", "status")).drop("said")
    for part in (shown, hours, staged):
        out = out.join(part, "month", "left")
    return out.selectExpr("month", "status", "coalesce(trips, 0) as trips", "coalesce(hours, 0) as hours", "revenue",
                          "coalesce(staged, 0) as staged")


# ---- streams -----------------------------------------------------------------

SLOTS = 6
_SLOT = "least(cast(floor(({us} - {low}) / ({span} / {slots})) as int), {slots} - 1)"
DELAY = "2 days"
LATE = 97


def _landed(spark, sf, late: bool = False):
    """Events in ``SLOTS`` folders by time, up to a day out of order; with ``late``, some in a last folder that are
    older than the watermark by then (rows are held against the watermark of the micro-batch before)."""
    root = scratch_path(spark, "landed")
    events = ad.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    us = "unix_micros(cast(ts as timestamp))"
    low, high = events.selectExpr(f"min({us})", f"max({us})").first()
    moved = f"({us} + pmod(hash(event_id), 86400) * 1000000L)"
    slot = _SLOT.format(us=moved, low=low, span=high - low + 86_400_000_000, slots=SLOTS)
    held = f"event_id % {LATE} = 0 and {us} < {high - 10 * 86_400_000_000}" if late else "false"
    dealt = events.selectExpr("*", f"case when {held} then {SLOTS} else {slot} end as slot")
    for i in range(SLOTS + 1):  # one after the other: a file stream goes by the time of writing
        dealt.where(F.col("slot") == i).drop("slot").coalesce(1).write.parquet(f"{root}/{i}")
    return root, events.schema


_LATE_SQL = f"event_id % {LATE} = 0 and ts < (select max(ts) - interval 10 day from events)"


@query("stream_hourly", f"""
with ends as (select max(ts) - interval 2 day as closed from events where not ({_LATE_SQL})),
h as (select date_trunc('hour', ts) as hour_start, event_type, count(*) as events, {exact_sum_sql('value')} as total
  from events where not ({_LATE_SQL}) group by all)
select * from h where hour_start + interval 1 hour <= (select closed from ends)""")
def stream_hourly(spark, sf):
    """Closed hours of a replay in files out of order; rows that land a month late change nothing."""
    root, schema = _landed(spark, sf, late=True)
    path = scratch_path(spark, "hours")
    stream = hourly.hourly_measures(hourly.follow_table(spark, root, schema), "ts", ["event_type"], "value", DELAY)
    hourly.run_into(stream, path, scratch_path(spark, "stream"), state_partitions=8)
    return spark.read.parquet(path).select(
        F.col("hour_start").cast("timestamp_ntz").alias("hour_start"), "event_type", "events", "total")


@query("stream_without_repeats", "select event_id, event_type, ts, value from events")
def stream_without_repeats(spark, sf):
    """Events that landed up to three times in different files, once each."""
    root, schema = _landed(spark, sf)
    twice = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    for i, some in enumerate(("event_id % 3 = 0", "event_id % 6 = 0")):
        twice.where(some).coalesce(1).write.parquet(f"{root}/again-{i}")
    path = scratch_path(spark, "once")
    stream = hourly.without_repeats(hourly.follow_table(spark, root, schema), "ts", ["event_id"], "60 days")
    hourly.run_into(stream, path, scratch_path(spark, "stream"), state_partitions=8)
    return spark.read.parquet(path).select("event_id", "event_type", "ts", "value")
