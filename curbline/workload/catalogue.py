"""Every registered query next to its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.numeric import exact_sum
from curbline.operators import clean, enrich, incremental, kpi, marts, quality, ranking
from curbline.operators.joins import dim_join, orphans
from curbline.plans import serving, warehouse
from curbline.schema import PARTITION_KEYS, SILVER, assert_schema, differences_frame
from curbline.session import scratch_path
from curbline.sources import catalog, readers, sinks, spines
from curbline.workload import adapter as ad
from curbline.workload.adapter import exact_avg_sql, exact_sum_sql, with_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# ---- shared frames -----------------------------------------------------------

def typed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Each feed with canonical names and types."""
    return {
        feed: clean.enforce_types(clean.normalize_columns(raw, feed))
        for feed, raw in ad.raw_feeds(spark, sf).items()
    }


def both(spark: SparkSession, sf: str) -> DataFrame:
    """Typed rows of both feeds before any gate."""
    return enrich.union_evolved([
        df.selectExpr("*", f"'{feed}' as vehicle_type") for feed, df in typed(spark, sf).items()
    ])


def silver(spark: SparkSession, sf: str, year: int | None = None, month: int | None = None) -> DataFrame:
    return enrich.union_evolved([
        clean.cleanse(raw, feed, year, month) for feed, raw in ad.raw_feeds(spark, sf).items()
    ])


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich(silver(spark, sf), ad.zones(spark, sf))


def picked(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with their pickup side only."""
    return enrich.enrich_for_kpis(silver(spark, sf), ad.zones(spark, sf))


def hours(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.hourly_kpis(picked(spark, sf))


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.with_rolling_week(hours(spark, sf))


def unkeyed_fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fact_trips(warehouse.staged(typed(spark, sf)))


def locations(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_location(readers.load_seed(ad.zones(spark, sf)))


def days(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_datetime(spines.date_spine(spark, *ad.pickup_days(spark, sf)))


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.hourly(typed(spark, sf), ad.zones(spark, sf), *ad.pickup_days(spark, sf))


SILVER_LIST = """VendorID, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
  cbd_congestion_fee, ehail_fee, trip_type, vehicle_type, trip_duration_min, speed_mph, pickup_date,
  pickup_year, pickup_month, pickup_hour, pickup_dow, trip_id"""
TRIP_LIST = """VendorID, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
  cbd_congestion_fee, ehail_fee, trip_type, vehicle_type"""


# ---- cleansing ---------------------------------------------------------------

_TEXT_SQL = {
    "VendorID": "case l_linenumber when 1 then '' when 2 then '  ' when 3 then 'abc' "
                "when 4 then cast(l_suppkey as string) || '.0' else cast(l_suppkey as string) end",
    "trip_distance": "case l_linenumber when 1 then '' when 5 then 'n/a' else cast(l_quantity as string) end",
    "passenger_count": "case when l_linenumber = 7 then null else ' ' || cast(l_linenumber as string) end",
    "unknown_col": "l_returnflag",
}


@query("clean_enforce_types", """
with texts as (
  select l_orderkey,
    case l_linenumber when 1 then '' when 2 then '  ' when 3 then 'abc'
      when 4 then cast(l_suppkey as varchar) || '.0' else cast(l_suppkey as varchar) end as VendorID,
    case l_linenumber when 1 then '' when 5 then 'n/a' else cast(l_quantity as varchar) end as trip_distance,
    case when l_linenumber = 7 then null else ' ' || cast(l_linenumber as varchar) end as passenger_count,
    l_returnflag as unknown_col, l_extendedprice as total_amount
  from lineitem
)
select l_orderkey, try_cast(try_cast(nullif(trim(VendorID), '') as double) as bigint) as VendorID,
  try_cast(nullif(trim(trip_distance), '') as double) as trip_distance,
  try_cast(nullif(trim(passenger_count), '') as bigint) as passenger_count,
  unknown_col, total_amount
from texts""")
def clean_enforce_types(spark, sf):
    texts = ad.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", *[f"{sql} as {name}" for name, sql in _TEXT_SQL.items()],
        "l_extendedprice as total_amount",
    )
    return clean.enforce_types(texts)


@query("clean_quality_gate", with_sql(*ad.SANE, final=f"select {TRIP_LIST} from gated"))
def clean_quality_gate(spark, sf):
    return clean.gate(both(spark, sf), clean.quality_rules())


@query("clean_derived", with_sql(*ad.SANE, final=f"select {SILVER_LIST} from derived"))
def clean_derived(spark, sf):
    good = clean.gate(both(spark, sf), clean.quality_rules())
    return clean.derive_trip_features(good)


@query("clean_sanity_gate", with_sql(*ad.SANE, final=f"select {SILVER_LIST} from sane"))
def clean_sanity_gate(spark, sf):
    return clean.gate(clean_derived(spark, sf), clean.sanity_rules())


@query("clean_trips", with_sql(*ad.SANE, final=f"select {SILVER_LIST} from silver"))
def clean_trips(spark, sf):
    return silver(spark, sf)


@query("clean_dedup", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def clean_dedup(spark, sf):
    lines = ad.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate",
    )
    return clean.dedup(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("clean_month", with_sql(*ad.SANE, final=f"""
select {SILVER_LIST} from silver where pickup_year = 1997 and pickup_month = 3"""))
def clean_month(spark, sf):
    return silver(spark, sf, 1997, 3)


@query("clean_reject_report", with_sql(_REJECT_BASE := ad._BASE_SQL, """
timed as (
  select *, date_diff('second', pickup_datetime, dropoff_datetime) / 60e0 as trip_duration_min
  from raw_trips
),
paced as (
  select *, case when trip_duration_min > 0 then trip_distance / (trip_duration_min / 60e0) end as speed_mph
  from timed
),
judged as (
  select case
    when pickup_datetime is null then 'pickup_datetime_missing'
    when dropoff_datetime is null then 'dropoff_datetime_missing'
    when PULocationID is null then 'pickup_zone_missing'
    when DOLocationID is null then 'dropoff_zone_missing'
    when not coalesce(trip_distance > 0 and trip_distance < 200, false) then 'distance_out_of_range'
    when not coalesce(total_amount > 0 and total_amount < 5000, false) then 'total_out_of_range'
    when passenger_count is null then 'passengers_missing'
    when passenger_count not between 1 and 6 then 'passengers_out_of_range'
    when not (trip_duration_min > 1 and trip_duration_min < 300) then 'duration_out_of_range'
    when speed_mph >= 120 then 'speed_out_of_range'
    else 'kept' end as reason
  from paced
),
reasons(reason) as (values ('pickup_datetime_missing'), ('dropoff_datetime_missing'),
  ('pickup_zone_missing'), ('dropoff_zone_missing'), ('distance_out_of_range'), ('total_out_of_range'),
  ('passengers_missing'), ('passengers_out_of_range'), ('duration_out_of_range'),
  ('speed_out_of_range'), ('kept'))""", final="""
select r.reason, count(j.reason) as row_count,
  count(j.reason) * 100e0 / (select count(*) from judged) as percent
from reasons r left join judged j on r.reason = j.reason group by r.reason"""))
def clean_reject_report(spark, sf):
    derived = clean.derive_trip_features(both(spark, sf))
    return clean.reject_breakdown(derived, {**clean.quality_rules(), **clean.sanity_rules()})


@query("union_evolved", with_sql(*ad.RAW, final="""
select vehicle_type, count(*) as trips, count(airport_fee) as with_airport_fee,
  count(cbd_congestion_fee) as with_cbd_fee, count(trip_type) as with_trip_type
from raw_trips group by vehicle_type"""))
def union_evolved(spark, sf):
    return both(spark, sf).groupBy("vehicle_type").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("airport_fee").alias("with_airport_fee"),
        F.count("cbd_congestion_fee").alias("with_cbd_fee"),
        F.count("trip_type").alias("with_trip_type"),
    )


# ---- enrichment and KPIs -----------------------------------------------------

@query("enrich_zones", with_sql(*ad.GOLD, final="""
select trip_id, vehicle_type, PULocationID, DOLocationID, pickup_borough, pickup_zone,
  pickup_service_zone, dropoff_borough, dropoff_zone from gold"""))
def enrich_zones(spark, sf):
    return enrich.enrich_zones(silver(spark, sf), ad.zones(spark, sf)).select(
        "trip_id", "vehicle_type", "PULocationID", "DOLocationID", "pickup_borough", "pickup_zone",
        "pickup_service_zone", "dropoff_borough", "dropoff_zone",
    )


@query("enrich_payment", with_sql(*ad.GOLD, final="""
select trip_id, vehicle_type, payment_type, payment_type_name from gold"""))
def enrich_payment(spark, sf):
    return enrich.enrich_payment(silver(spark, sf)).select(
        "trip_id", "vehicle_type", "payment_type", "payment_type_name"
    )


@query("enrich_features", with_sql(*ad.GOLD, final=f"""
select {SILVER_LIST}, pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone,
  payment_type_name, tip_rate, is_airport_trip, is_weekend, time_of_day from gold"""))
def enrich_features(spark, sf):
    return gold(spark, sf)


@query("kpi_hourly", with_sql(*ad.KPI, final="select * from hours"))
def kpi_hourly(spark, sf):
    return hours(spark, sf)


@query("kpi_rolling_7d", with_sql(*ad.KPI, final="select * from kpi"))
def kpi_rolling_7d(spark, sf):
    return kpis(spark, sf)


@query("kpi_rolling_events", f"""
with h as (
  select event_type, date_trunc('hour', ts) as hour_start, count(*) as n,
    {exact_sum_sql('value')} as total
  from events group by all
)
select event_type, hour_start, n, total,
  cast(sum(n) over w as double) / count(n) over w as rolling_n,
  {exact_avg_sql('total', ' over w')} as rolling_total
from h window w as (partition by event_type order by epoch(hour_start)
  range between 604800 preceding and current row)""")
def kpi_rolling_events(spark, sf):
    hourly = ad.table(spark, sf, "events").groupBy(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")
    ).agg(F.count(F.lit(1)).alias("n"), F.expr(f"{exact_sum('value')} as total"))
    return kpi.rolling_mean(
        hourly, ["event_type"], "hour_start", {"rolling_n": "n", "rolling_total": "total"}
    )


# ---- marts -------------------------------------------------------------------

@query("stage_trips", with_sql(*ad.STAGED, final="select * from staged"))
def stage_trips(spark, sf):
    return warehouse.staged(typed(spark, sf))


@query("union_keyed", with_sql(*ad.KEYED, final="select * from keyed"))
def union_keyed(spark, sf):
    return marts.with_trip_key(warehouse.staged(typed(spark, sf)))


@query("mart_fact", with_sql(*ad.KEYED_FACT, final="select * from fact"))
def mart_fact(spark, sf):
    return marts.fact_trips(union_keyed(spark, sf))


@query("dim_location", with_sql(*ad.LOCATIONS, final="select * from locations"))
def dim_location(spark, sf):
    return locations(spark, sf)


@query("dim_datetime", f"""
with bounds as (
  select cast(min(o_orderdate) as date) as first_day, cast(max(o_orderdate) as date) as last_day
  from orders
),
{ad._DAYS_SQL}
select days.* from days join bounds on date_day between first_day and last_day""")
def dim_datetime(spark, sf):
    first, last = ad.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))
    ).first()
    return marts.dim_datetime(spines.date_spine(spark, first, last))


@query("mart_hourly_obt", with_sql(*ad.MART, final="select * from mart"))
def mart_hourly_obt(spark, sf):
    return mart(spark, sf)


# ---- writes and increments ---------------------------------------------------

@query("incremental_lookback", """
select event_type, cast(ts as date) as day, count(*) as n
from events
where cast(ts as date) >= (select cast(max(ts) as date) - 3 from events)
group by all""")
def incremental_lookback(spark, sf):
    dated = ad.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    recent = incremental.lookback(dated, "day", incremental.latest_day(dated, "day"))
    return recent.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))


def _orders_by_month(spark, sf):
    return ad.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        F.year("o_orderdate").alias("o_year"), F.month("o_orderdate").alias("o_month"),
    )


@query("replace_month", f"""
with replaced as (
  select o_orderkey, o_orderpriority, cast(year(o_orderdate) as integer) as o_year,
    cast(month(o_orderdate) as integer) as o_month,
    case when year(o_orderdate) = 1997 and month(o_orderdate) = 3 then o_totalprice + 100 else o_totalprice
    end as o_totalprice
  from orders
  where not (year(o_orderdate) = 1997 and month(o_orderdate) = 3 and o_orderpriority = '5-LOW')
)
select o_year, o_month, count(*) as orders, {exact_sum_sql('o_totalprice')} as total
from replaced group by all""")
def replace_month(spark, sf):
    path = scratch_path(spark, "orders-by-month")
    orders = _orders_by_month(spark, sf)
    keys = ["o_year", "o_month"]
    sinks.write_partitioned(orders, path, keys)
    corrected = incremental.scope(
        orders, "o_year = 1997 and o_month = 3 and o_orderpriority <> '5-LOW'"
    ).withColumn("o_totalprice", F.col("o_totalprice") + 100)
    sinks.replace_partition(corrected, path, {"o_year": 1997, "o_month": 3})
    return readers.read_evolved(spark, path).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders"), F.expr(f"{exact_sum('o_totalprice')} as total")
    )


@query("insert_overwrite", f"""
with merged as (
  select cast(ts as date) as day,
    case when cast(ts as date) >= (select cast(max(ts) as date) - 3 from events) then value + 1 else value
    end as value
  from events
)
select day, count(*) as n, {exact_sum_sql('value')} as total from merged group by day""")
def insert_overwrite(spark, sf):
    path = scratch_path(spark, "events-by-day")
    events = ad.table(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    sinks.write_partitioned(events, path, ["day"])
    late = incremental.lookback(events, "day", incremental.latest_day(events, "day"))
    sinks.insert_overwrite(late.withColumn("value", F.col("value") + 1), path, ["day"])
    return readers.read_evolved(spark, path).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"{exact_sum('value')} as total")
    )


@query("evolved_read", f"""
select case when year(o_orderdate) >= 1998 then o_orderpriority end as o_orderpriority,
  count(*) as orders, {exact_sum_sql('o_totalprice')} as total
from orders group by 1""")
def evolved_read(spark, sf):
    path = scratch_path(spark, "orders-evolved")
    orders = _orders_by_month(spark, sf)
    older = orders.where(F.col("o_year") < 1998).drop("o_orderpriority")
    sinks.write_partitioned(older, path, ["o_year"])
    sinks.insert_overwrite(orders.where(F.col("o_year") >= 1998), path, ["o_year"])
    return readers.read_evolved(spark, path).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.expr(f"{exact_sum('o_totalprice')} as total")
    )


@query("file_manifest", """
select distinct cast(year(o_orderdate) as integer) as o_year, true as has_files from orders""")
def file_manifest(spark, sf):
    path = scratch_path(spark, "orders-manifest")
    sinks.write_partitioned(_orders_by_month(spark, sf), path, ["o_year"])
    listed = readers.file_manifest(spark.read.parquet(path), ["o_year"])
    return listed.groupBy("o_year").agg(
        (F.count_if(F.col("file_path").endswith(".parquet")) > 0).alias("has_files")
    )


@query("quarantine_partition", f"""
select event_type, cast(ts as date) as day, count(*) as n, {exact_sum_sql('value')} as total
from events
where event_type in (select event_type from events group by event_type having max(value) >= 100)
group by all""")
def quarantine_partition(spark, sf):
    path = scratch_path(spark, "quarantine")
    events = ad.table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    worst = events.groupBy("event_type").agg(F.max("value").alias("worst")).where("worst >= 100")
    failed = dim_join(events, worst.select("event_type"), "event_type", how="left_semi")
    sinks.quarantine(failed, path, ["event_type"])
    copied = sinks.existing_table(spark, path)
    if copied is None:
        copied = failed
    return copied.groupBy("event_type", "day").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"{exact_sum('value')} as total")
    )


@query("raw_month", """
select o_orderkey, o_orderstatus, o_totalprice from orders
where year(o_orderdate) = 1997 and month(o_orderdate) = 3""")
def raw_month(spark, sf):
    root = scratch_path(spark, "bronze")
    orders = ad.table(spark, sf, "orders")
    for month in (3, 4):
        landed = orders.where((F.year("o_orderdate") == 1997) & (F.month("o_orderdate") == month))
        landed.write.parquet(f"{root}/bronze/yellow/1997-{month:02d}")
    return readers.read_feed(spark, root, "yellow", 1997, 3).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("table_month", """
select o_orderkey, o_totalprice, o_orderpriority, cast(year(o_orderdate) as integer) as o_year,
  cast(month(o_orderdate) as integer) as o_month
from orders where year(o_orderdate) = 1997 and month(o_orderdate) = 3""")
def table_month(spark, sf):
    path = scratch_path(spark, "orders-months")
    sinks.write_partitioned(_orders_by_month(spark, sf), path, ["o_year", "o_month"])
    return readers.read_month(spark, path, 1997, 3, ("o_year", "o_month"))


@query("csv_zones", with_sql(ad._ZONE_SQL, final="select * from zones"))
def csv_zones(spark, sf):
    path = scratch_path(spark, "zones")
    ad.zones(spark, sf).write.option("header", "true").csv(path)
    return readers.read_zones(spark, path)


@query("feed_of_file", """
select case when l_linenumber = 6 then null when l_linenumber = 7 then 'fhvhv'
    when l_linestatus = 'F' then 'yellow' else 'green' end as feed, count(*) as files
from lineitem group by 1""")
def feed_of_file(spark, sf):
    named = ad.table(spark, sf, "lineitem").selectExpr(
        "concat(case when l_linenumber = 6 then 'zones' when l_linenumber = 7 then 'fhvhv' "
        "when l_linestatus = 'F' then 'yellow' else 'green' end, '_tripdata_', l_orderkey, '.parquet') as file")
    return named.groupBy(readers.feed_from_file_name("file").alias("feed")).agg(F.count(F.lit(1)).alias("files"))


@query("materialized_models", f"""
with o as (select o_orderstatus, o_totalprice, cast(year(o_orderdate) as integer) as o_year from orders)
select kind, o_orderstatus, count(*) as n, {exact_sum_sql('o_totalprice + shift')} as total
from (select *, unnest(['view', 'table', 'incremental']) as kind from o),
  (select 100e0 as add_1998) a, lateral (select case when kind = 'incremental' and o_year >= 1998
    then add_1998 else 0e0 end as shift) s
group by all""")
def materialized_models(spark, sf):
    path, mark = scratch_path(spark, "models"), uuid.uuid4().hex
    orders = ad.table(spark, sf, "orders").select(
        "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    newer = orders.where("o_year >= 1998").withColumn("o_totalprice", F.col("o_totalprice") + 100)
    sinks.materialize(orders, f"v_{mark}", "view")
    sinks.materialize(orders, f"t_{mark}", "table", f"{path}/t", ["o_year"])
    for batch in (orders, newer):
        sinks.materialize(batch, f"i_{mark}", "incremental", f"{path}/i", ["o_year"])
    made = [spark.table(f"{kind[0]}_{mark}").select("o_orderstatus", "o_totalprice", F.lit(kind).alias("kind"))
            for kind in ("view", "table", "incremental")]
    return made[0].unionByName(made[1]).unionByName(made[2]).groupBy("kind", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"{exact_sum('o_totalprice')} as total"))


@query("catalog_entry", f"""
select cast(year(o_orderdate) as integer) as o_year, count(*) as n, count(o_orderpriority) as with_priority,
  {exact_sum_sql('o_totalprice')} as total
from orders group by 1""")
def catalog_entry(spark, sf):
    path, database = scratch_path(spark, "entries"), f"lake_{uuid.uuid4().hex}"
    orders = _orders_by_month(spark, sf).drop("o_month")
    narrow = orders.where("o_year < 1998").drop("o_orderpriority")
    sinks.write_partitioned(narrow, f"{path}/old", ["o_year"])
    catalog.register_table(spark, database, "orders", f"{path}/old", narrow.schema, {"o_year": "int"})
    catalog.repair_table(spark, database, "orders")
    sinks.write_partitioned(orders, f"{path}/new", ["o_year"])
    catalog.register_table(spark, database, "orders", f"{path}/new", orders.schema, {"o_year": "int"})
    catalog.repair_table(spark, database, "orders")
    return spark.table(f"{database}.orders").groupBy("o_year").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("with_priority"),
        F.expr(f"{exact_sum('o_totalprice')} as total"))


@query("capped_rows", """
select least(count(*), 1000) as rows, least(count(*), 1000) as keys from lineitem""")
def capped_rows(spark, sf):
    lines = ad.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return ranking.capped(lines, 1000).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("l_orderkey", "l_linenumber").alias("keys"))


@query("declared_silver", with_sql(*ad.SANE, final="""
select vehicle_type, count(*) as trips from silver group by all"""))
def declared_silver(spark, sf):
    return assert_schema(silver(spark, sf), SILVER, PARTITION_KEYS).groupBy("vehicle_type").agg(
        F.count(F.lit(1)).alias("trips"))


def _landed(spark, feeds):
    """The feeds written once, as they lie in a lake: every later pass scans them instead of building them again."""
    out = {}
    for feed, df in feeds.items():
        path = scratch_path(spark, f"landed-{feed}")
        df.write.option("compression", "zstd").parquet(path)
        out[feed] = spark.read.schema(df.schema).parquet(path)
    return out


def _late_feeds(spark, sf):
    """The feeds without some of the last days' rows, and whole."""
    whole = _landed(spark, typed(spark, sf))
    newest = incremental.latest_day(warehouse.staged(whole), "pickup_date")
    early = {f: df.where(f"not (pickup_datetime >= date_sub(date '{newest}', 2) and PULocationID % 3 = 0)")
             for f, df in whole.items()}
    return early, whole


def _refreshed_fact(spark, sf, path):
    early, whole = _late_feeds(spark, sf)
    schema = marts.fact_trips(warehouse.staged(whole).withColumn("trip_id", F.lit(""))).schema
    warehouse.refresh_fact(early, path, full=True, contract=schema)
    return whole, schema


@query("fact_refresh", with_sql(*ad.KEYED_FACT, final="select * from fact"))
def fact_refresh(spark, sf):
    path = scratch_path(spark, "fact-days")
    whole, schema = _refreshed_fact(spark, sf, path)
    warehouse.refresh_fact(whole, path, contract=schema)
    return spark.read.schema(schema).parquet(path)


@query("mart_refresh", with_sql(*ad.MART, final="select * from mart"))
def mart_refresh(spark, sf):
    fact_path, path = scratch_path(spark, "fact-days"), scratch_path(spark, "mart-days")
    whole, schema = _refreshed_fact(spark, sf, fact_path)
    zones = ad.zones(spark, sf)
    warehouse.refresh_mart(spark.read.schema(schema).parquet(fact_path), zones, path, full=True)
    warehouse.refresh_fact(whole, fact_path, contract=schema)
    warehouse.refresh_mart(spark.read.schema(schema).parquet(fact_path), zones, path)
    return readers.read_evolved(spark, path)


_GRID_SQL = """
grid as (
  select feed, cast(m as date) as month_start
  from (values ('yellow'), ('green'), ('fhv')) f(feed),
    generate_series(timestamp '1995-01-01', timestamp '2002-12-01', interval 1 month) t(m)
),
landed as (
  select distinct case l_linestatus when 'F' then 'yellow' else 'green' end as feed,
    cast(date_trunc('month', o_orderdate) as date) as month_start
  from lineitem join orders on l_orderkey = o_orderkey
),
gone as (select feed, month_start from grid where feed = 'fhv' and month_start < date '2002-01-01')"""


def _coverage_inputs(spark, sf):
    expected = spines.expected_partitions(spark, ["yellow", "green", "fhv"], "1995-01-01", "2002-12-01")
    lines = ad.table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus")
    orders = ad.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    trips = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "feed", F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green")
    )
    landed = incremental.landed_months(trips, "feed", "o_orderdate")
    gone = expected.where((F.col("feed") == "fhv") & (F.col("month_start") < F.lit(date(2002, 1, 1))))
    return expected, landed, gone


@query("coverage_plan", with_sql(_GRID_SQL, final="""
select g.feed, g.month_start,
  case when gone.feed is not null then 'unavailable' when l.feed is not null then 'exists'
    else 'missing' end as status,
  g.feed in ('yellow', 'fhv') and g.month_start >= case g.feed when 'yellow' then date '2000-01-01'
    else date '2002-06-01' end as has_fee
from grid g
left join gone on g.feed = gone.feed and g.month_start = gone.month_start
left join landed l on g.feed = l.feed and g.month_start = l.month_start"""))
def coverage_plan(spark, sf):
    since = {"yellow": date(2000, 1, 1), "fhv": date(2002, 6, 1)}
    return incremental.coverage(*_coverage_inputs(spark, sf)).withColumn(
        "has_fee", spines.has_column_since("feed", "month_start", since)
    )


@query("coverage_work_list", with_sql(_GRID_SQL, final="""
select feed, month_start from grid
where (feed, month_start) not in (select feed, month_start from gone)
  and (feed, month_start) not in (select feed, month_start from landed)"""))
def coverage_work_list(spark, sf):
    return incremental.work_list(*_coverage_inputs(spark, sf))


# ---- data quality ------------------------------------------------------------

_VIEW_SQL = """
view as (
  select trip_id, pickup_date, vehicle_type as cab_type, PULocationID as pickup_location_id,
    DOLocationID as dropoff_location_id, fare_amount, total_amount,
    cast(trunc(trip_duration_min * 60) as bigint) as trip_duration_seconds
  from gold
)"""


def _check_sql(check_id, kind, column, severity, bad=None, success=None, observed=None, base=None):
    """One result row per check, from one scan of ``view`` each."""
    bad_count = f"count(*) filter (where {bad})" if bad else "cast(null as bigint)"
    base = base or f"count({column})"
    percent = f"case when {base} > 0 then {bad_count} * 100e0 / {base} end" if bad else "cast(null as double)"
    return f"""select '{check_id}' as check_id, '{kind}' as check_type,
  {f"'{column}'" if column else 'cast(null as varchar)'} as column_name, '{severity}' as severity,
  {success} as success, {observed or 'cast(null as double)'} as observed_value,
  count(*) as element_count, {bad_count} as unexpected_count, {percent} as unexpected_percent
from view"""


def _between_sql(check_id, column, low, high, severity, mostly):
    bad = f"{column} < {low} or {column} > {high}"
    ok = (f"case when count({column}) > 0 then (count({column}) - count(*) filter (where {bad}))"
          f" / cast(count({column}) as double) >= {mostly} else true end")
    return _check_sql(check_id, "between", column, severity, bad, ok)


_SUITE_SQL = "suite as (\n" + "\nunion all\n".join([
    _check_sql("CHK-001", "row_count", None, "CRITICAL", None, "count(*) between 1000 and 5000000",
               "cast(count(*) as double)"),
    _check_sql("CHK-002", "not_null", "trip_id", "CRITICAL", "trip_id is null",
               "count(*) = count(trip_id)", base="count(*)"),
    _check_sql("CHK-003", "not_null", "pickup_date", "CRITICAL", "pickup_date is null",
               "count(*) = count(pickup_date)", base="count(*)"),
    _between_sql("CHK-004", "pickup_location_id", 1, 265, "CRITICAL", 0.99),
    _between_sql("CHK-004b", "dropoff_location_id", 1, 265, "CRITICAL", 0.99),
    _between_sql("CHK-005", "fare_amount", 0, 2000, "WARNING", 0.995),
    _between_sql("CHK-006", "trip_duration_seconds", 30, 10800, "WARNING", 0.99),
    _check_sql("CHK-007", "in_set", "cab_type", "WARNING", "cab_type not in ('yellow', 'green')",
               "count(*) filter (where cab_type not in ('yellow', 'green')) = 0"),
]) + "\n)"
SUITE = (*ad.GOLD, _VIEW_SQL, _SUITE_SQL)


def checked(spark, sf):
    """The checked columns; none of them comes from a zone."""
    return quality.dq_view(enrich.enrich_payment(silver(spark, sf)))


def suite_results(spark, sf):
    return quality.run_suite(checked(spark, sf), quality.TRIP_SUITE)


@query("dq_suite", with_sql(*SUITE, final="select * from suite"))
def dq_suite(spark, sf):
    return suite_results(spark, sf)


@query("dq_documented", with_sql(*ad.GOLD, _VIEW_SQL, final="\nunion all\n".join([
    _between_sql("DOC-3", "total_amount", 0, 5000, "CRITICAL", 1.0),
    _between_sql("DOC-4", "pickup_location_id", 1, 263, "CRITICAL", 1.0),
    _check_sql("DOC-5", "row_count", None, "CRITICAL", None, "count(*) >= 500000",
               "cast(count(*) as double)"),
    _check_sql("DOC-6", "in_month", "pickup_date", "WARNING",
               "date_trunc('month', pickup_date) <> date '1997-03-01'",
               "count(*) filter (where date_trunc('month', pickup_date) <> date '1997-03-01') = 0"),
    _check_sql("DOC-7", "mean_between", "fare_amount", "WARNING", None,
               f"{exact_avg_sql('fare_amount')} between 5 and 100", exact_avg_sql("fare_amount")),
])))
def dq_documented(spark, sf):
    checks = quality.documented_checks(date(1997, 3, 1))
    return quality.run_suite(checked(spark, sf), checks)


@query("dq_unique", """
select l_orderkey, l_linenumber, count(*) as row_count from lineitem
group by all having count(*) > 1""")
def dq_unique(spark, sf):
    return quality.duplicate_keys(ad.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_fk", with_sql(*ad.SANE, ad._ZONE_SQL, final="""
select DOLocationID, count(*) as row_count from sane
where DOLocationID not in (select LocationID from zones) group by all"""))
def dq_fk(spark, sf):
    trips = clean_sanity_gate(spark, sf)
    return orphans(trips, "DOLocationID", ad.zones(spark, sf), "LocationID")


@query("dq_gate", with_sql(*SUITE, final="""
select count(*) filter (where not success and severity = 'CRITICAL') as critical_failed,
  count(*) filter (where not success and severity = 'WARNING') as warnings_failed,
  max(element_count) as rows,
  case when count(*) filter (where not success and severity = 'CRITICAL') > 0 or max(element_count) = 0
    then 'quarantine' else 'pass' end as decision
from suite"""))
def dq_gate(spark, sf):
    return quality.gate_decision(suite_results(spark, sf))


@query("dq_metrics", with_sql(*SUITE, final="""
select case check_id when 'CHK-005' then 'fare_amount_out_of_range_pct'
    when 'CHK-006' then 'trip_duration_out_of_range_pct' when 'CHK-007' then 'unknown_cab_type_count'
  end as metric_name,
  'dev' as env, 'all' as partition, check_id, coalesce(unexpected_percent, 100e0) as value,
  'Percent' as unit, timestamp '2001-08-02 00:00:00' as emitted_at
from suite where not success and severity = 'WARNING'"""))
def dq_metrics(spark, sf):
    return quality.warning_metrics(
        suite_results(spark, sf), quality.TRIP_SUITE, "dev", "all", datetime(2001, 8, 2)
    ).withColumn("emitted_at", F.col("emitted_at").cast("timestamp_ntz"))


@query("dq_summary", with_sql(*SUITE, final="""
select count(*) as total, count(*) filter (where success) as passed,
  count(*) filter (where not success) as failed,
  coalesce(string_agg(check_id, ',' order by check_id) filter (where not success and severity = 'CRITICAL'),
    '') as critical_failures,
  coalesce(string_agg(check_id, ',' order by check_id) filter (where not success and severity = 'WARNING'),
    '') as warnings
from suite"""))
def dq_summary(spark, sf):
    return quality.summary(suite_results(spark, sf))


def _constraint_sql(table: str, source: str) -> str:
    c = quality.MART_CONSTRAINTS[table]

    def row(check_id, kind, column, bad, rows, base, tail=""):
        return (f"select '{check_id}' as check_id, '{kind}' as check_type, '{column}' as column_name, "
                f"'CRITICAL' as severity, {bad} = 0 as success, cast(null as double) as observed_value, "
                f"cast({rows} as bigint) as element_count, cast({bad} as bigint) as unexpected_count, "
                f"case when {base} > 0 then {bad} * 100e0 / {base} end as unexpected_percent "
                f"from {source} {tail}")

    out = []
    for n in c.not_null:
        out.append(row(f"{table}.{n}.not_null", "not_null", n,
                       f"count(*) filter (where {n} is null)", "count(*)", "count(*)"))
    for n, values in c.accepted.items():
        words = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        out.append(row(f"{table}.{n}.accepted", "in_set", n,
                       f"count(*) filter (where {n} not in ({words}))", "count(*)", f"count({n})"))
    for n in c.unique:
        out.append(row(f"{table}.{n}.unique", "unique", n, f"(count({n}) - count({n}) filter (where {n} in "
                       f"(select {n} from {source} group by {n} having count(*) = 1)))",
                       f"count({n})", f"count({n})"))
    for n, (parent, key) in c.references.items():
        out.append(row(f"{table}.{n}.relationship", "relationship", n,
                       f"count({n}) filter (where {n} not in (select {key} from locations))",
                       f"count({n})", f"count({n})"))
    return "\nunion all\n".join(out)


@query("dq_constraints_location", with_sql(*ad.LOCATIONS, final=_constraint_sql("dim_location", "locations")))
def dq_constraints_location(spark, sf):
    return quality.run_constraints("dim_location", locations(spark, sf))


@query("dq_constraints_fact", with_sql(
    *ad.KEYED_FACT, *ad.LOCATIONS, final=_constraint_sql("fact_trips", "fact")))
def dq_constraints_fact(spark, sf):
    path = scratch_path(spark, "fact")
    mart_fact(spark, sf).select(*quality.constrained_columns("fact_trips")).write.option("compression", "zstd").parquet(path)
    return quality.run_constraints(
        "fact_trips", spark.read.parquet(path), {"dim_location": locations(spark, sf)}
    )


@query("dq_constraints_mart", with_sql(
    *ad.MART, final=_constraint_sql("mart_hourly_kpi", "mart") + "\nunion all\n"
    + _constraint_sql("dim_datetime", "days")))
def dq_constraints_mart(spark, sf):
    return quality.union_results([
        quality.run_constraints("mart_hourly_kpi", mart(spark, sf)),
        quality.run_constraints("dim_datetime", days(spark, sf)),
    ])


@query("dq_profile", with_sql(*ad.RAW, final="\nunion all\n".join(
    f"select '{c}' as column_name, count(*) as row_count, count(*) filter (where {c} is null) as null_count, "
    f"count(*) filter (where {c} is null) / cast(count(*) as double) as null_rate from raw_trips"
    for c in [x.strip() for x in TRIP_LIST.split(",")])))
def dq_profile(spark, sf):
    return quality.profile(both(spark, sf))


_UNEXPECTED = ("RatecodeID", "VendorID", "ehail_fee", "extra", "improvement_surcharge", "mta_tax",
               "store_and_fwd_flag", "tip_amount", "tolls_amount", "trip_type", "congestion_surcharge")


@query("dq_schema_contract", """
with found(feed, finding, column_name, severity, min_rows) as (
  values ('green', 'missing_column', 'payment_type', 'CRITICAL', 0),
""" + ",\n".join(f"    ('green', 'unexpected_column', '{c}', 'WARNING', 0)" for c in _UNEXPECTED) + """
)
select f.feed, f.finding, f.column_name, f.severity
from found f, (select count(*) as n from lineitem where l_linestatus = 'O') t
where t.n >= min_rows
union all
select 'green', 'too_few_rows', null, 'CRITICAL' from lineitem where l_linestatus = 'O' having count(*) < 100""")
def dq_schema_contract(spark, sf):
    return quality.file_contract(ad.raw_feeds(spark, sf)["green"].drop("payment_type"), "green")


@query("dq_schema_differences", """
with t as (
  select count(*) as n, count(case when l_partkey % 4 = 0 then 1 end) as with_cbd
  from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'F'
)
select 'yellow' as feed, c as column_name, 'unexpected' as finding, n as row_count,
  case when c = 'cbd_congestion_fee' then n - with_cbd else 0 end as null_count
from (values ('RatecodeID'), ('VendorID'), ('Airport_fee'), ('cbd_congestion_fee'), ('extra'),
  ('improvement_surcharge'), ('mta_tax'), ('store_and_fwd_flag'), ('tip_amount'), ('tolls_amount'),
  ('congestion_surcharge')) v(c), t""")
def dq_schema_differences(spark, sf):
    raw = ad.raw_feeds(spark, sf)["yellow"]
    found = differences_frame(spark, raw, "yellow")
    filled = quality.profile(raw).select("column_name", "row_count", "null_count")
    return found.join(filled, "column_name", "left").select(
        "feed", "column_name", "finding", "row_count", "null_count"
    )


@query("dq_freshness", """
select 'events' as source, max(ts) as newest,
  date_sub('second', max(ts), timestamp '2024-02-01 00:00:00') as age_seconds,
  case when date_sub('second', max(ts), timestamp '2024-02-01 00:00:00') > 49 * 3600 then 'error'
    when date_sub('second', max(ts), timestamp '2024-02-01 00:00:00') > 25 * 3600 then 'warn'
    else 'pass' end as status
from events""")
def dq_freshness(spark, sf):
    return quality.freshness(ad.table(spark, sf, "events"), "ts", "2024-02-01 00:00:00", "events")


# ---- serving -----------------------------------------------------------------

def _mart_sql(final: str) -> str:
    return with_sql(*ad.MART, final=final)


def _kpi_sql(final: str) -> str:
    return with_sql(*ad.KPI, final=final)


def _gold_sql(final: str) -> str:
    return with_sql(*ad.GOLD, final=final)


_GROUP_SQL = """case when pickup_borough = 'Manhattan' then 'Manhattan'
  when pickup_borough in ('Brooklyn', 'Queens', 'Bronx', 'Staten Island') then 'Outer boroughs'
  else 'Unknown / EWR' end"""


@query("serve_monthly_volume", _mart_sql(
    "select year_month, cast(sum(trip_count) as bigint) as trips from mart group by all"))
def serve_monthly_volume(spark, sf):
    return serving.monthly_volume(mart(spark, sf))


@query("serve_avg_fare_by_group", _kpi_sql(f"""
select {_GROUP_SQL} as borough_group, {exact_avg_sql('avg_fare')} as avg_fare from kpi group by all"""))
def serve_avg_fare_by_group(spark, sf):
    return serving.avg_fare_by_group(hours(spark, sf))


@query("serve_total_trips", _mart_sql("select cast(sum(trip_count) as bigint) as trips from mart"))
def serve_total_trips(spark, sf):
    return serving.total_trips(mart(spark, sf))


@query("serve_total_revenue", _mart_sql(f"select {exact_sum_sql('total_revenue')} as revenue from mart"))
def serve_total_revenue(spark, sf):
    return serving.total_revenue(mart(spark, sf))


@query("serve_volume_heatmap", _mart_sql("""
select pickup_hour, day_name, trips,
  cast(trips - min(trips) over () as double) / (max(trips) over () - min(trips) over ()) as intensity
from (select pickup_hour, day_name, cast(sum(trip_count) as bigint) as trips from mart group by all)"""))
def serve_volume_heatmap(spark, sf):
    return serving.volume_heatmap(mart(spark, sf))


@query("serve_fare_heatmap", _kpi_sql(f"""
select pickup_hour, cast(isodow(pickup_date) as integer) as day_of_week,
  {exact_avg_sql('avg_fare')} as avg_fare from kpi group by all"""))
def serve_fare_heatmap(spark, sf):
    return serving.fare_heatmap(hours(spark, sf))


@query("serve_revenue_by_group", with_sql(*ad.KPI, *ad.MART[1:2], *ad.MART[2:3], ad._LOCATION_SQL, *ad.DAYS,
                                          ad._MART_SQL, final=f"""
select m.*, k.avg_fare from (
  select borough_group, cast(sum(trip_count) as bigint) as trips,
    {exact_sum_sql('total_revenue')} as revenue, {exact_avg_sql('avg_duration_minutes')} as avg_duration
  from mart group by all) m
left join (select {_GROUP_SQL} as borough_group, {exact_avg_sql('avg_fare')} as avg_fare
  from kpi group by all) k on m.borough_group = k.borough_group
order by revenue desc, m.borough_group limit 20"""))
def serve_revenue_by_group(spark, sf):
    return serving.revenue_by_group(mart(spark, sf), hours(spark, sf))


@query("serve_daily_duration", _mart_sql(f"""
select pickup_date, {exact_avg_sql('avg_duration_minutes')} as avg_duration from mart group by all"""))
def serve_daily_duration(spark, sf):
    return serving.daily_duration(mart(spark, sf))


@query("serve_daily_speed", _mart_sql(f"""
select pickup_date, {exact_avg_sql('avg_speed_mph')} as avg_speed from mart group by all"""))
def serve_daily_speed(spark, sf):
    return serving.daily_speed(mart(spark, sf))


@query("serve_payment_share", with_sql(*ad.FACT, final="""
select payment_type, trips, cast(trips as double) / cast(sum(trips) over () as double) as share
from (select payment_type, count(*) as trips from fact group by all)"""))
def serve_payment_share(spark, sf):
    return serving.payment_share(unkeyed_fact(spark, sf))


@query("serve_airport_split", _mart_sql(
    "select is_airport, cast(sum(trip_count) as bigint) as trips from mart group by all"))
def serve_airport_split(spark, sf):
    return serving.airport_split(mart(spark, sf))


@query("serve_weekend_split", _mart_sql(
    "select is_weekend, cast(sum(trip_count) as bigint) as trips from mart group by all"))
def serve_weekend_split(spark, sf):
    return serving.weekend_split(mart(spark, sf))


@query("serve_revenue_per_mile", _kpi_sql(f"""
select {_GROUP_SQL} as borough_group, {exact_avg_sql('revenue_per_mile')} as revenue_per_mile
from kpi group by all"""))
def serve_revenue_per_mile(spark, sf):
    return serving.revenue_per_mile_by_group(kpis(spark, sf))


@query("serve_big_numbers", _kpi_sql(f"""
select {exact_avg_sql('avg_fare')} as avg_fare, {exact_avg_sql('avg_distance_mi')} as avg_distance_mi,
  {exact_avg_sql('avg_duration_min')} as avg_duration_min from kpi"""))
def serve_big_numbers(spark, sf):
    return serving.big_numbers(hours(spark, sf))


@query("serve_trips_by_hour", _mart_sql(
    "select pickup_hour, cast(sum(trip_count) as bigint) as trips from mart group by all"))
def serve_trips_by_hour(spark, sf):
    return serving.trips_by_hour(mart(spark, sf))


@query("serve_daily_revenue_trend", _mart_sql(f"""
select *, {exact_avg_sql('revenue', ' over w')}
  as rolling_revenue
from (select cab_type, pickup_date, {exact_sum_sql('total_revenue')} as revenue from mart group by all)
window w as (partition by cab_type order by pickup_date rows between 6 preceding and current row)"""))
def serve_daily_revenue_trend(spark, sf):
    return serving.daily_revenue_trend(mart(spark, sf))


@query("serve_feed_share", _gold_sql("""
select pickup_borough, vehicle_type, trips,
  cast(trips as double) / cast(sum(trips) over (partition by pickup_borough) as double) as share
from (select pickup_borough, vehicle_type, count(*) as trips from gold group by all)"""))
def serve_feed_share(spark, sf):
    return serving.feed_share_by_borough(picked(spark, sf))


def _top_sql(zone: str, k: int, where: str = "") -> str:
    return _gold_sql(f"select {zone}, count(*) as trips from gold {where} group by all "
                     f"order by trips desc, {zone} nulls first limit {k}")


@query("serve_top_pickup_zones", _top_sql("pickup_zone", 15))
def serve_top_pickup_zones(spark, sf):
    return serving.top_zones(picked(spark, sf), "pickup_zone")


@query("serve_top_dropoff_zones", _top_sql("dropoff_zone", 15))
def serve_top_dropoff_zones(spark, sf):
    return serving.top_zones(gold(spark, sf), "dropoff_zone")


@query("serve_avg_fare_month", _gold_sql(f"""
select {exact_avg_sql('fare_amount')} as avg_fare, count(*) as trips from gold
where vehicle_type = 'yellow' and year(pickup_date) = 1997 and month(pickup_date) = 1"""))
def serve_avg_fare_month(spark, sf):
    return serving.avg_fare_of(silver(spark, sf), "yellow", 1997, 1)


@query("serve_busiest_zone", _top_sql(
    "pickup_zone", 1, "where year(pickup_date) = 1997 and quarter(pickup_date) = 1"))
def serve_busiest_zone(spark, sf):
    return serving.busiest_zone(picked(spark, sf), 1997, 1)


@query("serve_credit_cash", _gold_sql("""
select count(*) as trips,
  count(*) filter (where payment_type_name = 'Credit card') * 100e0 / count(*) as credit_percent,
  count(*) filter (where payment_type_name = 'Cash') * 100e0 / count(*) as cash_percent
from gold where year(pickup_date) = 1997 and vehicle_type = 'yellow'"""))
def serve_credit_cash(spark, sf):
    return serving.credit_cash_share(enrich.enrich_payment(silver(spark, sf)), 1997, "yellow")


@query("serve_hourly_pattern", _gold_sql("""
select pickup_hour, cast(sum(trips) as double) / count(*) as avg_trips from (
  select pickup_date, pickup_hour, count(*) as trips from gold
  where pickup_borough = 'Manhattan' and year(pickup_date) = 1997 group by all) group by pickup_hour"""))
def serve_hourly_pattern(spark, sf):
    return serving.hourly_pattern(picked(spark, sf), "Manhattan", 1997)


@query("serve_empty_day", _gold_sql(
    "select count(*) as trips from gold where pickup_date = date '2099-01-01'"))
def serve_empty_day(spark, sf):
    return serving.trips_on(silver(spark, sf), "2099-01-01")


@query("serve_borough_hour_revenue", _kpi_sql(f"""
select pickup_borough, pickup_hour, {exact_sum_sql('total_revenue')} as revenue from kpi group by all"""))
def serve_borough_hour_revenue(spark, sf):
    return serving.revenue_by_borough_hour(hours(spark, sf))


@query("serve_weekly_trend", _kpi_sql("""
select pickup_borough, pickup_date, round(arg_max(rolling_7d_trips, pickup_hour), 6) as rolling_7d_trips
from kpi group by all"""))
def serve_weekly_trend(spark, sf):
    return serving.weekly_trend(kpis(spark, sf))


@query("serve_airport_fares", _gold_sql(f"""
select is_airport_trip, {exact_avg_sql('fare_amount')} as avg_fare, count(*) as trips
from gold group by all"""))
def serve_airport_fares(spark, sf):
    return serving.airport_fares(picked(spark, sf))


@query("serve_filtered", _mart_sql("""
select cab_type, borough_group, cast(sum(trip_count) as bigint) as trips from mart
where pickup_date between date '1997-01-01' and date '1997-12-31'
  and cab_type in ('yellow') and borough_group in ('Manhattan', 'Outer boroughs') group by all"""))
def serve_filtered(spark, sf):
    picked = serving.filtered(
        mart(spark, sf), "1997-01-01", "1997-12-31", ["yellow"], ["Manhattan", "Outer boroughs"]
    )
    return picked.groupBy("cab_type", "borough_group").agg(F.sum("trip_count").alias("trips"))


@query("serve_search", """
select * from part
where lower(cast(p_partkey as varchar)) like '%ring%' or lower(p_name) like '%ring%'
  or lower(p_brand) like '%ring%' or lower(p_type) like '%ring%'
  or lower(cast(p_size as varchar)) like '%ring%' or lower(cast(p_retailprice as varchar)) like '%ring%'""")
def serve_search(spark, sf):
    return ranking.search_rows(ad.table(spark, sf, "part"), "Ring")


@query("sample_capped", """
select least(count(*), 5000) as rows, least(count(*), 5000) as found from lineitem""")
def sample_capped(spark, sf):
    lines = ad.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    drawn = ranking.sample_capped(lines, 5000)
    known = ad.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return drawn.join(known.withColumn("known", F.lit(1)), "l_orderkey", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count("known").alias("found")
    )


_SCORED_SQL = """
cases(case_id, wanted, barred) as (values
  ('avg_fare_jan2023', ['average', 'fare', 'january', '2023'], cast([] as varchar[])),
  ('top_pickup_zone', ['zone', 'trips', '2023'], ['i don''t know', 'cannot determine']),
  ('payment_type_share', ['credit card', 'cash', 'percent'], cast([] as varchar[])),
  ('hourly_pattern', ['hour', 'manhattan', 'trips'], cast([] as varchar[])),
  ('empty_result_graceful', ['no', 'zero', '0', 'empty', 'returned', 'none'], ['error', 'exception'])
),
marked as (
  select conv_id, turn, length(text) as answer_length, case_id,
    len(list_filter(wanted, lambda w: contains(lower(text), w))) / cast(len(wanted) as double) as precision,
    len(list_filter(barred, lambda w: contains(lower(text), w))) > 0 as forbidden_hit
  from conversations, cases
),
scored as (select *, precision = 1 and not forbidden_hit as passed from marked)"""


def _scored(spark, sf):
    turns = ad.table(spark, sf, "conversations").withColumn(
        "answer_length", F.length("text").cast("long")
    )
    return serving.score_answers(turns, "text").select(
        "conv_id", "turn", "answer_length", "case_id", "precision", "forbidden_hit", "passed"
    )


@query("score_keywords", with_sql(_SCORED_SQL, final="select * from scored"))
def score_keywords(spark, sf):
    return _scored(spark, sf)


@query("score_summary", with_sql(_SCORED_SQL, """
ranked as (
  select case_id, answer_length, row_number() over (partition by case_id order by answer_length) - 1 as i,
    count(*) over (partition by case_id) as n
  from scored
)""", final=f"""
select s.case_id, s.pass_rate, s.precision_mean, r.latency_p50, r.latency_p95
from (select case_id, cast(sum(cast(passed as bigint)) as double) / count(*) as pass_rate,
    {exact_avg_sql('precision')} as precision_mean from scored group by all) s
join (select case_id,
    min(answer_length) filter (where i = least(cast(floor(n * 0.5e0) as bigint), n - 1)) as latency_p50,
    min(answer_length) filter (where i = least(cast(floor(n * 0.95e0) as bigint), n - 1)) as latency_p95
  from ranked group by all) r on s.case_id = r.case_id"""))
def score_summary(spark, sf):
    return serving.score_summary(_scored(spark, sf), "answer_length")
