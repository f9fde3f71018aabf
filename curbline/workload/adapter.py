"""The supplied tables in the shape of trip feeds and zones (see FIXTURES.md).

Money is built from whole cents, so that both engines see the same doubles.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import settle

FEED_STATUS = {"yellow": "F", "green": "O"}

# Lines dealt to one task of the join.
ROWS_PER_TASK = 1_000_000

BOROUGH_OF_REGION = {
    "AFRICA": "Manhattan",
    "AMERICA": "Brooklyn",
    "ASIA": "Queens",
    "EUROPE": "Bronx",
    "MIDDLE EAST": "Staten Island",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_TRIP_SQL = {
    "VendorID": "cast(l_linenumber % 2 + 1 as bigint)",
    "pickup_datetime": "picked_up",
    "dropoff_datetime":
        "cast(timestampadd(MINUTE, cast(l_quantity * (l_suppkey % 9) as int), picked_up) as timestamp_ntz)",
    "passenger_count": "case when l_partkey % 97 <> 0 then cast(l_linenumber as bigint) end",
    "trip_distance": "price_cents / 100000D",
    "RatecodeID": "l_partkey % 8",
    "store_and_fwd_flag": "l_returnflag",
    "PULocationID": "case when l_quantity = 50 then -1L else l_suppkey end",
    "DOLocationID": "l_partkey % 120",
    "payment_type": "cast(substr(o_orderpriority, 1, 1) as bigint)",
    "fare_amount": "fare_cents / 100D",
    "extra": "0.5D * (l_linenumber % 3)",
    "mta_tax": "0.5D",
    "tip_amount": "(fare_cents * discount_pct div 100) / 100D",
    "tolls_amount": "case when l_suppkey % 10 = 0 then 6.55D else 0D end",
    "improvement_surcharge": "0.3D",
    "total_amount":
        "(fare_cents + fare_cents * discount_pct div 100 + fare_cents * tax_pct div 100) / 100D",
    "congestion_surcharge": "tax_pct / 10D",
}
_FEED_ONLY_SQL = {
    "yellow": {
        "Airport_fee": "case when l_suppkey % 10 = 0 then 1.75D else 0D end",
        "cbd_congestion_fee": "case when l_partkey % 4 = 0 then 0.75D end",
    },
    "green": {
        "ehail_fee": "cast(null as double)",
        "trip_type": "cast(l_linenumber % 2 + 1 as bigint)",
    },
}
_RAW_CLOCKS = {"yellow": "tpep_", "green": "lpep_"}


def pickup_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The first and last day a trip can begin: pickups lie up to a day behind their order."""
    first, last = table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return first, last + timedelta(days=1)


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both feeds as they would land: feed-specific clock names, vintage spellings."""
    # Dealt by the join key at every size: a file with one row group would be read by one task.
    lines = table(spark, sf_dir, "lineitem")
    # A task sorts its rows: where rows are many, their number per task is held instead of their compressed bytes,
    # which say little when few columns are read. The count comes from the footers.
    tasks = -(-lines.count() // ROWS_PER_TASK)
    if tasks > spark.sparkContext.defaultParallelism:
        lines = lines.repartition(tasks, "l_orderkey")
    else:
        lines = lines.repartition("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    # Orders grow with the lines: where one column is read they look small enough to broadcast, and every task would hold them.
    cents = lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "*",
        "cast(rint(l_extendedprice * 100) as bigint) as price_cents",
        "cast(rint(l_extendedprice * 100) as bigint) div 500 as fare_cents",
        "cast(rint(l_discount * 100) as bigint) as discount_pct",
        "cast(rint(l_tax * 100) as bigint) as tax_pct",
        "cast(timestampadd(MINUTE, cast((l_partkey * 7 + l_suppkey * 13) % 1440 as int), o_orderdate)"
        " as timestamp_ntz) as picked_up",
    )

    def shaped(feed: str) -> DataFrame:
        prefix = _RAW_CLOCKS[feed]
        return cents.where(f"l_linestatus = '{FEED_STATUS[feed]}'").selectExpr(*[
            f"{sql} as {prefix + name if name.endswith('_datetime') else name}"
            for name, sql in {**_TRIP_SQL, **_FEED_ONLY_SQL[feed]}.items()
        ])

    return {feed: shaped(feed) for feed in FEED_STATUS}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as zones, their regions as boroughs."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    boroughs = " ".join(f"when '{name}' then '{shown}'" for name, shown in BOROUGH_OF_REGION.items())
    return placed.selectExpr(
        "cast(s_suppkey as int) as LocationID",
        f"case r_name {boroughs} end as Borough",
        "case s_suppkey % 10 when 0 then 'JFK ' || s_name when 1 then 'Newark ' || s_name else s_name end"
        " as Zone",
        "case when s_suppkey % 10 = 0 then 'Airports' when s_suppkey % 10 = 1 then 'EWR' "
        "when r_name = 'AFRICA' then 'Yellow Zone' else 'Boro Zone' end as service_zone",
    )


# ---- the same shapes in SQL, for the side-by-side check ----------------------

_BASE_SQL = """
base as (
  select *,
    cast(l_extendedprice * 100 as bigint) as price_cents,
    cast(l_extendedprice * 100 as bigint) // 500 as fare_cents,
    cast(l_discount * 100 as bigint) as discount_pct,
    cast(l_tax * 100 as bigint) as tax_pct,
    o_orderdate + to_minutes((l_partkey * 7 + l_suppkey * 13) % 1440) as picked_up
  from lineitem join orders on l_orderkey = o_orderkey
),
raw_trips as (
  select
    cast(l_linenumber % 2 + 1 as bigint) as VendorID,
    picked_up as pickup_datetime,
    picked_up + to_minutes(cast(l_quantity * (l_suppkey % 9) as bigint)) as dropoff_datetime,
    case when l_partkey % 97 <> 0 then cast(l_linenumber as bigint) end as passenger_count,
    price_cents / 100000e0 as trip_distance,
    l_partkey % 8 as RatecodeID,
    l_returnflag as store_and_fwd_flag,
    case when l_quantity = 50 then -1 else l_suppkey end as PULocationID,
    l_partkey % 120 as DOLocationID,
    cast(substr(o_orderpriority, 1, 1) as bigint) as payment_type,
    fare_cents / 100e0 as fare_amount,
    0.5e0 * (l_linenumber % 3) as extra,
    0.5e0 as mta_tax,
    (fare_cents * discount_pct // 100) / 100e0 as tip_amount,
    case when l_suppkey % 10 = 0 then 6.55e0 else 0e0 end as tolls_amount,
    0.3e0 as improvement_surcharge,
    (fare_cents + fare_cents * discount_pct // 100 + fare_cents * tax_pct // 100) / 100e0 as total_amount,
    tax_pct / 10e0 as congestion_surcharge,
    case when l_linestatus = 'F' then case when l_suppkey % 10 = 0 then 1.75e0 else 0e0 end end as airport_fee,
    case when l_linestatus = 'F' and l_partkey % 4 = 0 then 0.75e0 end as cbd_congestion_fee,
    cast(null as double) as ehail_fee,
    case when l_linestatus = 'O' then cast(l_linenumber % 2 + 1 as bigint) end as trip_type,
    case l_linestatus when 'F' then 'yellow' when 'O' then 'green' end as vehicle_type
  from base
)"""

_ZONE_SQL = """
zones as (
  select cast(s_suppkey as integer) as LocationID,
    case r_name when 'AFRICA' then 'Manhattan' when 'AMERICA' then 'Brooklyn' when 'ASIA' then 'Queens'
      when 'EUROPE' then 'Bronx' when 'MIDDLE EAST' then 'Staten Island' end as Borough,
    case s_suppkey % 10 when 0 then 'JFK ' || s_name when 1 then 'Newark ' || s_name
      else s_name end as Zone,
    case when s_suppkey % 10 = 0 then 'Airports' when s_suppkey % 10 = 1 then 'EWR'
      when r_name = 'AFRICA' then 'Yellow Zone' else 'Boro Zone' end as service_zone
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""

_GATED_SQL = """
gated as (
  select * from raw_trips
  where pickup_datetime is not null and dropoff_datetime is not null
    and PULocationID is not null and DOLocationID is not null
    and trip_distance > 0 and trip_distance < 200
    and total_amount > 0 and total_amount < 5000
    and passenger_count >= 1 and passenger_count <= 6
),
timed as (
  select *, date_diff('second', pickup_datetime, dropoff_datetime) / 60e0 as trip_duration_min
  from gated
),
derived as (
  select *,
    case when trip_duration_min > 0 then trip_distance / (trip_duration_min / 60e0) end as speed_mph,
    cast(pickup_datetime as date) as pickup_date,
    cast(year(pickup_datetime) as integer) as pickup_year,
    cast(month(pickup_datetime) as integer) as pickup_month,
    cast(hour(pickup_datetime) as integer) as pickup_hour,
    cast(dayofweek(pickup_datetime) + 1 as integer) as pickup_dow,
    sha256(concat_ws('|', cast(VendorID as varchar), cast(pickup_datetime as varchar),
      cast(PULocationID as varchar), cast(DOLocationID as varchar))) as trip_id
  from timed
),
sane as (
  select * from derived
  where trip_duration_min > 1 and trip_duration_min < 300 and (speed_mph is null or speed_mph < 120)
),
silver as (
  select * from sane
  qualify row_number() over (
    partition by vehicle_type, VendorID, pickup_datetime, PULocationID, DOLocationID
    order by dropoff_datetime nulls first, passenger_count nulls first, trip_distance nulls first,
      RatecodeID nulls first, store_and_fwd_flag nulls first, payment_type nulls first,
      fare_amount nulls first, extra nulls first, mta_tax nulls first, tip_amount nulls first,
      tolls_amount nulls first, improvement_surcharge nulls first, total_amount nulls first,
      congestion_surcharge nulls first, airport_fee nulls first, cbd_congestion_fee nulls first,
      ehail_fee nulls first, trip_type nulls first) = 1
)"""

_GOLD_SQL = """
payments(payment_type, payment_type_name) as (
  values (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'),
    (6, 'Voided trip')
),
gold as (
  select s.*, p.Borough as pickup_borough, p.Zone as pickup_zone, p.service_zone as pickup_service_zone,
    d.Borough as dropoff_borough, d.Zone as dropoff_zone, payments.payment_type_name,
    case when fare_amount > 0 then tip_amount / fare_amount else 0e0 end as tip_rate,
    p.service_zone in ('Airports', 'EWR') as is_airport_trip,
    pickup_dow in (1, 7) as is_weekend,
    case when pickup_hour between 6 and 9 then 'morning_rush'
      when pickup_hour between 10 and 15 then 'midday'
      when pickup_hour between 16 and 20 then 'evening_rush'
      when pickup_hour between 21 and 23 then 'night' else 'late_night' end as time_of_day
  from silver s
  left join zones p on s.PULocationID = p.LocationID
  left join zones d on s.DOLocationID = d.LocationID
  left join payments on s.payment_type = payments.payment_type
)"""


def decimal_sql(x: str) -> str:
    """The shortest text of a number as a decimal; a direct cast would go through a rounded double."""
    return f"cast(cast({x} as varchar) as decimal(38, 12))"


def exact_sum_sql(x: str, over: str = "") -> str:
    return f"cast(cast(sum({decimal_sql(x)}){over} as varchar) as double)"


def exact_avg_sql(x: str, over: str = "") -> str:
    return f"({exact_sum_sql(x, over)} / count({x}){over})"


_KPI_SQL = f"""
hours as (
  select pickup_date, pickup_hour, pickup_borough,
    count(*) as trip_count,
    {exact_sum_sql('total_amount')} as total_revenue,
    {exact_avg_sql('fare_amount')} as avg_fare,
    {exact_avg_sql('trip_distance')} as avg_distance_mi,
    {exact_avg_sql('trip_duration_min')} as avg_duration_min,
    {exact_avg_sql('tip_rate')} as avg_tip_rate,
    cast(sum(cast(is_airport_trip as bigint)) as bigint) as airport_trips,
    cast(sum(cast(is_weekend as bigint)) as bigint) as weekend_trips,
    count(distinct PULocationID) as unique_pickup_zones
  from gold group by all
),
stamped as (
  select *, cast(pickup_date as timestamp) + to_hours(pickup_hour) as pickup_datetime_hour
  from hours
),
kpi as (
  select *,
    cast(sum(trip_count) over w as double) / count(trip_count) over w as rolling_7d_trips,
    {exact_avg_sql('total_revenue', ' over w')} as rolling_7d_revenue,
    case when avg_distance_mi > 0 then avg_fare / avg_distance_mi end as revenue_per_mile
  from stamped
  window w as (partition by pickup_borough order by epoch(pickup_datetime_hour)
    range between 604800 preceding and current row)
)"""

_STAGED_SQL = """
staged as (
  select cast(VendorID as integer) as vendor_id, cast(RatecodeID as integer) as rate_code_id,
    cast(PULocationID as integer) as pickup_location_id,
    cast(DOLocationID as integer) as dropoff_location_id,
    cast(payment_type as integer) as payment_type_id, store_and_fwd_flag,
    cast(passenger_count as integer) as passenger_count, trip_distance as trip_distance_miles,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge, airport_fee, pickup_datetime as pickup_at, dropoff_datetime as dropoff_at,
    cast(pickup_datetime as date) as pickup_date, cast(hour(pickup_datetime) as integer) as pickup_hour,
    date_sub('second', pickup_datetime, dropoff_datetime) as trip_duration_seconds,
    vehicle_type as cab_type
  from raw_trips
  where pickup_datetime is not null and dropoff_datetime is not null
    and pickup_datetime < dropoff_datetime and total_amount >= 0
)"""

_KEYED_SQL = """
numbered as (
  select *, row_number() over (
    partition by pickup_at, dropoff_at, pickup_location_id, dropoff_location_id, fare_amount, cab_type
    order by total_amount nulls first, tip_amount nulls first, vendor_id nulls first,
      rate_code_id nulls first, payment_type_id nulls first, store_and_fwd_flag nulls first,
      passenger_count nulls first, trip_distance_miles nulls first, extra nulls first,
      mta_tax nulls first, tolls_amount nulls first, improvement_surcharge nulls first,
      congestion_surcharge nulls first, airport_fee nulls first, pickup_date nulls first,
      pickup_hour nulls first, trip_duration_seconds nulls first) as ordinal
  from staged
),
keyed as (
  select * exclude (ordinal), sha256(cast(pickup_at as varchar) || '|' || cast(dropoff_at as varchar)
    || '|' || cast(pickup_location_id as varchar) || '|' || cast(dropoff_location_id as varchar)
    || '|' || cast(fare_amount as varchar) || '|' || cab_type || '|' || cast(ordinal as varchar))
    as trip_id
  from numbered
)"""


def _fact_sql(source: str) -> str:
    return f"""
rates(rate_code_id, rate_code_desc) as (
  values (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
    (5, 'Negotiated fare'), (6, 'Group ride')
),
payment_names(payment_type_id, payment_type_desc) as (
  values (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'),
    (6, 'Voided trip')
),
fact as (
  select t.* exclude (payment_type_id, rate_code_id),
    coalesce(payment_type_desc, 'Unknown') as payment_type,
    coalesce(rate_code_desc, 'Unknown') as rate_code,
    round(trip_distance_miles / nullif(trip_duration_seconds / 3600e0, 0), 2) as avg_speed_mph,
    case when fare_amount > 0 then round(tip_amount / fare_amount * 100, 2) end as tip_pct,
    case when trip_distance_miles > 0 then round(total_amount / trip_distance_miles, 2) end
      as revenue_per_mile
  from {source} t
  left join payment_names on t.payment_type_id = payment_names.payment_type_id
  left join rates on t.rate_code_id = rates.rate_code_id
)"""


_LOCATION_SQL = """
locations as (
  select LocationID as location_id, Zone as zone_name, Borough as borough, service_zone,
    case when Borough = 'Manhattan' then 'Manhattan'
      when Borough in ('Brooklyn', 'Queens', 'Bronx', 'Staten Island') then 'Outer boroughs'
      else 'Unknown / EWR' end as borough_group,
    coalesce(lower(Zone) like '%jfk%' or lower(Zone) like '%laguardia%' or lower(Zone) like '%newark%',
      false) as is_airport,
    coalesce(Borough = 'Manhattan' and service_zone = 'Yellow Zone', false) as is_manhattan_cbd
  from zones
)"""


_DAYS_SQL = """
spine as (
  select cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as date_day
  from (select date_trunc('day', min(o_orderdate)) as first_day,
    date_trunc('day', max(o_orderdate)) + interval 1 day as last_day from orders)
),
days as (
  select date_day, cast(year(date_day) as integer) as year, cast(month(date_day) as integer) as month,
    cast(day(date_day) as integer) as day_of_month, cast(isodow(date_day) as integer) as day_of_week,
    cast(weekofyear(date_day) as integer) as week_of_year,
    cast(quarter(date_day) as integer) as quarter,
    strftime(date_day, '%Y-%m') as year_month, strftime(date_day, '%A') as day_name,
    strftime(date_day, '%B') as month_name,
    cast(year(date_day) as varchar) || '-Q' || cast(quarter(date_day) as varchar) as year_quarter,
    isodow(date_day) in (6, 7) as is_weekend,
    case strftime(date_day, '%m-%d') when '01-01' then 'New Year''s Day'
      when '07-04' then 'Independence Day' when '11-11' then 'Veterans Day'
      when '12-25' then 'Christmas Day' end as us_holiday_name,
    strftime(date_day, '%m-%d') in ('01-01', '07-04', '11-11', '12-25') as is_us_holiday
  from spine
)"""



_MART_SQL = f"""
placed as (
  select f.*, borough_group, is_airport, is_manhattan_cbd
  from fact f left join locations l on f.pickup_location_id = l.location_id
),
grouped as (
  select pickup_date, pickup_hour, cab_type, borough_group, is_airport, is_manhattan_cbd,
    count(*) as trip_count,
    cast(sum(passenger_count) as bigint) as total_passengers,
    round({exact_sum_sql('trip_distance_miles')}, 2) as total_distance_miles,
    round({exact_avg_sql('trip_distance_miles')}, 3) as avg_distance_miles,
    round({exact_avg_sql('trip_duration_seconds')} / 60e0, 2) as avg_duration_minutes,
    round(quantile_disc(trip_duration_seconds, 0.5) / 60e0, 2) as median_duration_minutes,
    round({exact_avg_sql('avg_speed_mph')}, 2) as avg_speed_mph,
    round({exact_sum_sql('fare_amount')}, 2) as total_fare,
    round({exact_sum_sql('tip_amount')}, 2) as total_tips,
    round({exact_sum_sql('total_amount')}, 2) as total_revenue,
    round({exact_avg_sql('total_amount')}, 2) as avg_revenue_per_trip,
    round({exact_avg_sql('tip_pct')}, 2) as avg_tip_pct,
    round({exact_sum_sql('congestion_surcharge')}, 2) as total_congestion_surcharge,
    round({exact_sum_sql('airport_fee')}, 2) as total_airport_fee,
    count(*) filter (where payment_type = 'Credit card') as credit_card_trips,
    count(*) filter (where payment_type = 'Cash') as cash_trips,
    round({exact_sum_sql('total_amount')} / count(*), 2) as revenue_per_trip
  from placed group by all
),
mart as (
  select g.*, is_weekend, is_us_holiday, day_name, month_name, year_month, year_quarter
  from grouped g left join days on g.pickup_date = days.date_day
)"""


def with_sql(*parts: str, final: str) -> str:
    return "with " + ",".join(parts) + "\n" + final


RAW = (_BASE_SQL,)
SANE = (_BASE_SQL, _GATED_SQL)
GOLD = (_BASE_SQL, _ZONE_SQL, _GATED_SQL, _GOLD_SQL)
KPI = (*GOLD, _KPI_SQL)
STAGED = (_BASE_SQL, _STAGED_SQL)
KEYED = (*STAGED, _KEYED_SQL)
FACT = (*STAGED, _fact_sql("staged"))
KEYED_FACT = (*KEYED, _fact_sql("keyed"))
LOCATIONS = (_ZONE_SQL, _LOCATION_SQL)
DAYS = (_DAYS_SQL,)
MART = (*FACT, *LOCATIONS, *DAYS, _MART_SQL)
