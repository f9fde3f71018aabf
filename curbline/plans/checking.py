"""The quality run on one partition: check, report, set aside, decide."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from curbline.operators import quality
from curbline.schema import REQUIRED_COLUMNS
from curbline.sources import footers
from curbline.sources.readers import path_exists, raw_month_path
from curbline.sources.sinks import quarantine, write_report

SUITE_NAME = "trip_suite"


def admit_feed(raw: DataFrame, feed: str | None, quarantine_path: str) -> list[str]:
    """Hold a raw month to its feed's contract; its rows are copied aside when it fails.

    Returns the critical findings, none for a month that may go on.
    """
    critical = [
        r for r in quality.file_contract(raw, feed).collect() if r.severity == quality.CRITICAL
    ]
    if critical:
        raw.write.mode("overwrite").parquet(quarantine_path)
    return [f"{r.finding}: {r.column_name}" if r.column_name else r.finding for r in critical]


def admit_month(spark: SparkSession, root: str, feed: str, year: int, month: int,
                min_rows: int = quality.MIN_FILE_ROWS) -> list[str]:
    """The same for a landed month, from its file footers: no row is read unless the month is set aside.

    A month that has not landed is a finding too.
    """
    path = raw_month_path(root, feed, year, month)
    if not path_exists(spark, path):
        return ["not_landed"]
    raw = spark.read.parquet(path)
    counts = footers.footer_counts(spark, path) if feed in REQUIRED_COLUMNS else None
    found = quality.file_contract(raw, feed, min_rows, counts=counts)
    critical = [r for r in found.orderBy("finding", "column_name").collect() if r.severity == quality.CRITICAL]
    if critical:
        raw.write.mode("overwrite").parquet(f"{root}/quarantine/bronze/{feed}/{year:04d}-{month:02d}")
    return [f"{r.finding}: {r.column_name}" if r.column_name else r.finding for r in critical]


@dataclass(frozen=True)
class Outcome:
    passed: bool
    critical: tuple[str, ...]
    warnings: tuple[str, ...]


def check_partition(fact: DataFrame, partition: str, keys: Sequence[str], report_path: str,
                    quarantine_path: str, checks: Sequence[quality.Check] = quality.TRIP_SUITE) -> Outcome:
    """Run the suite over every row of a partition and act on the result.

    A critical failure, or an empty partition, copies the rows aside and fails;
    warnings are only reported. The report is written either way. What comes
    back to the driver is one row per check.
    """
    results = quality.run_suite(quality.dq_view(fact), checks)
    rows = results.collect()
    kept = fact.sparkSession.createDataFrame(rows, results.schema)
    write_report(kept, report_path, SUITE_NAME, partition)
    write_report(quality.summary(kept), f"{report_path}-totals", SUITE_NAME, partition)
    failed = [r for r in rows if not r.success]
    critical = tuple(r.check_id for r in failed if r.severity == quality.CRITICAL)
    empty = rows[0].element_count == 0 if rows else True
    if critical and not empty:
        quarantine(fact, quarantine_path, keys)
    warnings = tuple(r.check_id for r in failed if r.severity == quality.WARNING)
    return Outcome(not critical and not empty, critical, warnings)
