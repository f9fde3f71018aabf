"""One run over both feeds: admit, month, marts, constraints, gate, catalog; and the runs still to do.

Steps of a month hand each other written tables. A month that is not admitted, or that the gate stops, leaves its rows in
``quarantine`` and is not entered in the catalog. Everything a run decides is written below ``reports`` and read
back from there: :func:`run_log` is also what tells which months are still to be run. The loop over months runs on the
driver, as each month is a set of Spark jobs of its own; what comes back to it is a few numbers a month.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import incremental, marts, quality
from curbline.plans import warehouse
from curbline.plans.checking import admit_month, check_partition
from curbline.plans.monthly import FEEDS, run_month
from curbline.schema import (
    DIM_DATETIME, DIM_LOCATION, FACT_TRIPS, GOLD_FACT, GOLD_KPI, MART_HOURLY, PARTITION_KEYS, SILVER, STAGED, assert_schema,
)
from curbline.sources import catalog, readers, sinks, spines

PUBLISHED, NOT_ADMITTED, STOPPED, FAILED = "published", "not admitted", "stopped", "failed"
_LOG = "month date, status string, findings array<string>, trips long, hours long, mart_rows long"
# Tables of a month below the root, with their contracts, as entered in the catalog.
MONTH_TABLES: dict[str, T.StructType] = {
    **{f"silver/{feed}": SILVER for feed in FEEDS}, "gold/fact_trips": GOLD_FACT, "gold/hourly_kpis": GOLD_KPI,
    "marts/fact_trips": FACT_TRIPS, "marts/mart_hourly_kpi": MART_HOURLY, "marts/dim_datetime": DIM_DATETIME,
}


@dataclass(frozen=True)
class MonthRun:
    month: date
    status: str
    findings: tuple[str, ...] = ()
    trips: int = 0
    hours: int = 0
    mart_rows: int = 0


def _keyed(df: DataFrame, target: dict[str, int]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in target.items()})


def build_marts(spark: SparkSession, root: str, year: int, month: int, zones: DataFrame) -> int:
    """The star schema of one month from its clean feeds; every table is held to its contract before it is written.

    Returns the rows of the hourly mart. Locations are replaced whole, as the lookup has no months.
    """
    target = dict(zip(PARTITION_KEYS, (year, month), strict=True))
    feeds = {f: readers.read_month(spark, f"{root}/silver/{f}", year, month) for f in FEEDS}
    staged = assert_schema(warehouse.staged(feeds), STAGED)
    fact = assert_schema(marts.fact_trips(marts.with_trip_key(staged)), FACT_TRIPS)
    sinks.replace_partition(_keyed(fact, target), f"{root}/marts/fact_trips", target, FACT_TRIPS)
    assert_schema(marts.dim_location(readers.load_seed(zones)), DIM_LOCATION).write.mode("overwrite").parquet(
        f"{root}/marts/dim_location")
    first = date(year, month, 1)
    last = F.last_day(F.lit(first))
    days = assert_schema(marts.dim_datetime(spines.date_spine(spark, first, spark.range(1).select(last).first()[0])),
                         DIM_DATETIME)
    sinks.replace_partition(_keyed(days, target), f"{root}/marts/dim_datetime", target, DIM_DATETIME)
    hourly = assert_schema(
        marts.mart_hourly(_month(spark, root, "marts/fact_trips", year, month), _locations(spark, root), days), MART_HOURLY)
    return sinks.replace_partition(_keyed(hourly, target), f"{root}/marts/mart_hourly_kpi", target, MART_HOURLY)


def _month(spark: SparkSession, root: str, table: str, year: int, month: int) -> DataFrame:
    return readers.read_month(spark, f"{root}/{table}", year, month).drop(*PARTITION_KEYS)


def _locations(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DIM_LOCATION).parquet(f"{root}/marts/dim_location")


def check_marts(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """All constraints of the marts on the written month, as result rows, which are reported."""
    places = _locations(spark, root)
    results = quality.union_results([
        quality.run_constraints("fact_trips", _month(spark, root, "marts/fact_trips", year, month),
                                {"dim_location": places}),
        quality.run_constraints("mart_hourly_kpi", _month(spark, root, "marts/mart_hourly_kpi", year, month)),
        quality.run_constraints("dim_datetime", _month(spark, root, "marts/dim_datetime", year, month)),
        quality.run_constraints("dim_location", places),
    ])
    sinks.write_report(results, f"{root}/reports/marts", "mart_constraints", f"{year:04d}-{month:02d}")
    return spark.read.schema(results.schema).json(f"{root}/reports/marts/partition={year:04d}-{month:02d}")


def enter_tables(spark: SparkSession, root: str, database: str) -> None:
    """Entries for all month tables; one without a month yet reads as empty."""
    for table, contract in MONTH_TABLES.items():
        catalog.register_table(spark, database, table.replace("/", "_"), f"{root}/{table}", contract,
                               dict.fromkeys(PARTITION_KEYS, "int"))


def enter_month(spark: SparkSession, root: str, year: int, month: int, database: str) -> None:
    """Show a month's tables in the catalog, and list their files in manifests."""
    target = dict(zip(PARTITION_KEYS, (year, month), strict=True))
    leaf = "/".join(f"{k}={v}" for k, v in target.items())
    enter_tables(spark, root, database)
    for table in MONTH_TABLES:
        name, path = table.replace("/", "_"), f"{root}/{table}"
        catalog.register_partition(spark, database, name, target, f"{path}/{leaf}")
        spark.catalog.refreshTable(f"{database}.{name}")
        files = readers.file_listing(spark, f"{path}/{leaf}").select("file_path")
        sinks.write_manifest(_keyed(files, target), f"{root}/manifests/{table}/{year:04d}-{month:02d}", PARTITION_KEYS)
    catalog.register_table(spark, database, "marts_dim_location", f"{root}/marts/dim_location", DIM_LOCATION)


def process_month(spark: SparkSession, root: str, year: int, month: int, zones: DataFrame, database: str,
                  checks: Sequence[quality.Check] = quality.TRIP_SUITE, tolerated: Sequence[str] = (),
                  min_rows: int = quality.MIN_FILE_ROWS) -> MonthRun:
    """Bring one month of both feeds from landing to the catalog, or set it aside.

    Constraints named in ``tolerated`` are reported and do not stop the month. Running a month again replaces it.
    """
    at = date(year, month, 1)
    found = tuple(f"{feed}: {f}" for feed in FEEDS for f in admit_month(spark, root, feed, year, month, min_rows))
    if found:
        return _logged(spark, root, MonthRun(at, NOT_ADMITTED, found))
    counts = run_month(spark, root, year, month, zones)
    mart_rows = build_marts(spark, root, year, month, zones)
    outcome = check_partition(
        readers.read_month(spark, f"{root}/gold/fact_trips", year, month), f"{year:04d}-{month:02d}", PARTITION_KEYS,
        f"{root}/reports/trips", f"{root}/quarantine/fact_trips", checks)
    broken = [r.check_id for r in check_marts(spark, root, year, month).where(
        f"not success and severity = '{quality.CRITICAL}'").orderBy("check_id").collect() if r.check_id not in tolerated]
    found = (*outcome.critical, *broken) or (() if outcome.passed else ("no rows",))
    if not found:
        enter_month(spark, root, year, month, database)
    status = STOPPED if found else PUBLISHED
    return _logged(spark, root, MonthRun(at, status, found, counts.enriched, counts.kpi, mart_rows))


def _logged(spark: SparkSession, root: str, run: MonthRun) -> MonthRun:
    row = (run.month, run.status, list(run.findings), run.trips, run.hours, run.mart_rows)
    spark.createDataFrame([row], _LOG).coalesce(1).write.mode("overwrite").json(f"{root}/reports/runs/{run.month:%Y-%m}")
    return run


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """The last run of every month, as written."""
    names = readers.child_names(spark, f"{root}/reports/runs")
    if not names:
        return spark.createDataFrame([], _LOG)
    return spark.read.schema(_LOG).json([f"{root}/reports/runs/{n}" for n in names])


def landed(spark: SparkSession, root: str) -> DataFrame:
    """(feed, month_start) of the landed months, from the names of their directories."""
    rows = [(feed, name) for feed in FEEDS for name in readers.child_names(spark, f"{root}/bronze/{feed}")]
    return spark.createDataFrame(rows, "feed string, name string").selectExpr(
        "feed", "try_to_date(name, 'yyyy-MM') as month_start").where("month_start is not null")


def month_plan(spark: SparkSession, root: str, start: date | str, end: date | str) -> DataFrame:
    """Every month from ``start`` to ``end`` with what is to be done: unavailable, missing, published or pending.

    A month waits until all its feeds have landed; one that was stopped is pending again.
    """
    expected = spines.expected_partitions(spark, FEEDS, start, end)
    gone = spark.createDataFrame(spines.unpublished_months(), "feed string, month_start date")
    feeds = incremental.coverage(expected, landed(spark, root), gone).groupBy("month_start").agg(
        F.expr("count_if(status = 'unavailable') as gone"), F.expr("count_if(status = 'missing') as waits"))
    done = run_log(spark, root).where(f"status = '{PUBLISHED}'").selectExpr("month as month_start", "true as done")
    return feeds.join(done, "month_start", "left").selectExpr(
        "month_start", "case when gone > 0 then 'unavailable' when waits > 0 then 'missing' "
        f"when done then '{PUBLISHED}' else 'pending' end as status")


def run_months(spark: SparkSession, root: str, start: date | str, end: date | str, zones: DataFrame, database: str,
               **options) -> list[MonthRun]:
    """Run every pending month in order; a month that fails is logged and the next one is run.

    Months already published are left alone, so a broken-off run is taken up by calling this again.
    """
    enter_tables(spark, root, database)
    todo = month_plan(spark, root, start, end).where("status = 'pending'").orderBy("month_start").collect()
    runs = []
    for at in (r.month_start for r in todo):
        try:
            runs.append(process_month(spark, root, at.year, at.month, zones, database, **options))
        except (PySparkException, Py4JJavaError, ValueError) as e:
            reason = str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__
            runs.append(_logged(spark, root, MonthRun(at, FAILED, (reason,))))
    return runs
