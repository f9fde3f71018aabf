"""Data-quality checks: one aggregate pass per frame, results as rows.

All row-level checks of a suite share a single aggregation, and so do references to a
small parent. Uniqueness and other reference checks need their own shuffle and count per key before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.numeric import exact_avg
from curbline.functions.trip import text_list
from curbline.operators.joins import dim_join, small_enough
from curbline.schema import OPTIONAL_COLUMNS, REQUIRED_COLUMNS, column_differences

CRITICAL, WARNING = "CRITICAL", "WARNING"


@dataclass(frozen=True)
class Check:
    """One expectation. ``kind`` is a key of the table of row-level kinds below."""

    check_id: str
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    mostly: float = 1.0
    severity: str = CRITICAL
    metric: str | None = None
    month: date | None = field(default=None)


# The suite run on the enriched fact.
TRIP_SUITE: tuple[Check, ...] = (
    Check("CHK-001", "row_count", low=1000, high=5000000),
    Check("CHK-002", "not_null", "trip_id"),
    Check("CHK-003", "not_null", "pickup_date"),
    Check("CHK-004", "between", "pickup_location_id", 1, 265, mostly=0.99),
    Check("CHK-004b", "between", "dropoff_location_id", 1, 265, mostly=0.99),
    Check("CHK-005", "between", "fare_amount", 0.0, 2000.0, mostly=0.995, severity=WARNING,
          metric="fare_amount_out_of_range_pct"),
    Check("CHK-006", "between", "trip_duration_seconds", 30, 10800, mostly=0.99, severity=WARNING,
          metric="trip_duration_out_of_range_pct"),
    Check("CHK-007", "in_set", "cab_type", values=("yellow", "green"), severity=WARNING,
          metric="unknown_cab_type_count"),
)


def documented_checks(month: date) -> tuple[Check, ...]:
    """The checks that the published table of checks adds."""
    return (
        Check("DOC-3", "between", "total_amount", 0, 5000),
        Check("DOC-4", "between", "pickup_location_id", 1, 263),
        Check("DOC-5", "row_count", low=500000),
        Check("DOC-6", "in_month", "pickup_date", month=month, severity=WARNING),
        Check("DOC-7", "mean_between", "fare_amount", 5, 100, severity=WARNING),
    )


def dq_view(fact: DataFrame) -> DataFrame:
    """The enriched fact under the names the suite checks."""
    return fact.selectExpr(
        "trip_id", "pickup_date", "pickup_datetime as pickup_at", "dropoff_datetime as dropoff_at",
        "vehicle_type as cab_type", "PULocationID as pickup_location_id",
        "DOLocationID as dropoff_location_id", "fare_amount",
        "cast(trip_duration_min * 60 as bigint) as trip_duration_seconds",
        "total_amount", "payment_type_name as payment_type", "passenger_count",
    )


def one_day(df: DataFrame, day: date | str, column: str = "pickup_date") -> DataFrame:
    return df.where(f"{column} = date '{day}'")


def _within(x: str, low: float | None, high: float | None) -> str:
    sides = [f"{x} >= {low}" for _ in (1,) if low is not None]
    sides += [f"{x} <= {high}" for _ in (1,) if high is not None]
    return " and ".join(sides) or "true"


def _literals(values: Sequence) -> str:
    return text_list(values) if isinstance(values[0], str) else ", ".join(str(v) for v in values)


def _bad(check: Check) -> str:
    """True for a row that fails a row-level check; NULL values pass all but not_null."""
    c = f"`{check.column}`"
    if check.kind == "not_null":
        return f"{c} is null"
    if check.kind == "between":
        return f"not ({_within(c, check.low, check.high)})"
    if check.kind == "in_set":
        return f"{c} not in ({_literals(check.values)})"
    if check.kind == "in_month":
        return f"trunc({c}, 'month') <> date '{check.month}'"
    if check.kind == "relationship":
        return f"{c} is not null and `{_flag(check.column)}` is null"
    raise ValueError(f"unknown check kind {check.kind!r}")


def _flag(key: str) -> str:
    """The column that is true in rows whose ``key`` has a parent."""
    return f"_known_{key}"


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One result row per check, over every row of the frame, in one job.

    The wanted share (``mostly``) is of the non-NULL values; a column without
    any passes.
    """
    measures = ["count(1) as all_rows"]
    for i, check in enumerate(checks):
        if check.kind == "mean_between":
            measures.append(f"{exact_avg(f'`{check.column}`')} as mean_{i}")
        elif check.kind != "row_count":
            measures.append(f"count_if({_bad(check)}) as bad_{i}")
            measures.append(f"count(`{check.column}`) as known_{i}")
    results = ", ".join(_result(i, check) for i, check in enumerate(checks))
    return df.agg(*[F.expr(m) for m in measures]).selectExpr(f"inline(array({results}))")


def _result(i: int, check: Check) -> str:
    """The result row of one check, as the text of a struct."""
    observed, bad, percent = "cast(null as double)", "cast(null as bigint)", "cast(null as double)"
    if check.kind == "row_count":
        observed = "cast(all_rows as double)"
        success = _within("all_rows", check.low, check.high)
    elif check.kind == "mean_between":
        observed = f"mean_{i}"
        success = f"coalesce({_within(observed, check.low, check.high)}, false)"
    else:
        base = "all_rows" if check.kind == "not_null" else f"known_{i}"
        bad = f"bad_{i}"
        percent = f"case when {base} > 0 then {bad} * 100D / {base} end"
        success = f"coalesce(try_divide({base} - {bad}, {base}) >= {check.mostly}D, true)"
    column = f"'{check.column}'" if check.column else "cast(null as string)"
    rows = f"known_{i}" if check.kind == "relationship" else "all_rows"
    return (
        f"named_struct('check_id', '{check.check_id}', 'check_type', '{check.kind}', "
        f"'column_name', {column}, 'severity', '{check.severity}', 'success', {success}, "
        f"'observed_value', {observed}, 'element_count', {rows}, 'unexpected_count', {bad}, "
        f"'unexpected_percent', {percent})"
    )


def check_unique(df: DataFrame, keys: Sequence[str], check_id: str, severity: str = CRITICAL) -> DataFrame:
    """Rows whose key occurs more than once; NULL keys are left out."""
    per_key = df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(
        F.expr("count(1) as n")
    )
    total = per_key.agg(
        F.expr("coalesce(sum(n), 0) as rows"),
        F.expr("coalesce(sum(case when n > 1 then n end), 0) as bad"),
    )
    return total.selectExpr(*_shuffled_result(check_id, "unique", ",".join(keys), severity))


def check_reference(child: DataFrame, key: str, parent: DataFrame, parent_key: str, check_id: str,
                    severity: str = CRITICAL) -> DataFrame:
    """Rows whose key is absent from the parent, counted per key before the join."""
    per_key = child.where(f"{key} is not null").groupBy(key).agg(F.expr("count(1) as n"))
    known = parent.selectExpr(f"{parent_key} as {key}", "true as _known").distinct()
    total = per_key.join(known, key, "left").agg(
        F.expr("coalesce(sum(n), 0) as rows"),
        F.expr("coalesce(sum(case when _known is null then n end), 0) as bad"),
    )
    return total.selectExpr(*_shuffled_result(check_id, "relationship", key, severity))


def _shuffled_result(check_id: str, kind: str, column: str, severity: str) -> list[str]:
    return [
        f"'{check_id}' as check_id", f"'{kind}' as check_type", f"'{column}' as column_name",
        f"'{severity}' as severity", "bad = 0 as success", "cast(null as double) as observed_value",
        "rows as element_count", "bad as unexpected_count",
        "case when rows > 0 then bad * 100D / rows end as unexpected_percent",
    ]


def union_results(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.expr("count(1) as row_count")).where("row_count > 1")


def summary(results: DataFrame) -> DataFrame:
    """Totals and the failed check ids by severity; one row."""
    def ids(severity: str) -> str:
        hit = f"case when not success and severity = '{severity}' then check_id end"
        return f"array_join(array_sort(collect_list({hit})), ',')"

    return results.agg(
        F.expr("count(1) as total"),
        F.expr("count_if(success) as passed"),
        F.expr("count_if(not success) as failed"),
        F.expr(f"{ids(CRITICAL)} as critical_failures"),
        F.expr(f"{ids(WARNING)} as warnings"),
    )


def gate_decision(results: DataFrame) -> DataFrame:
    """``quarantine`` when a critical check failed or there were no rows, else ``pass``."""
    counted = results.agg(
        F.expr(f"count_if(not success and severity = '{CRITICAL}') as critical_failed"),
        F.expr(f"count_if(not success and severity = '{WARNING}') as warnings_failed"),
        F.expr("coalesce(max(element_count), 0) as rows"),
    )
    return counted.selectExpr(
        "*", "case when critical_failed > 0 or rows = 0 then 'quarantine' else 'pass' end as decision"
    )


def warning_metrics(results: DataFrame, checks: Sequence[Check], env: str, partition: str,
                    at: datetime | None = None) -> DataFrame:
    """One metric row per failed warning check."""
    name = F.concat(F.col("check_id"), F.lit("_failure"))
    for c in checks:
        if c.metric:
            name = F.when(F.col("check_id") == c.check_id, c.metric).otherwise(name)
    stamp = F.lit(at) if at else F.current_timestamp()
    return results.where(~F.col("success") & (F.col("severity") == WARNING)).select(
        name.alias("metric_name"), F.lit(env).alias("env"), F.lit(partition).alias("partition"),
        "check_id", F.coalesce("unexpected_percent", F.lit(100.0)).alias("value"),
        F.lit("Percent").alias("unit"), stamp.alias("emitted_at"),
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, NULL count and NULL rate per column, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.expr("count(1) as row_count"),
        *[F.expr(f"count_if(`{c}` is null) as null_{i}") for i, c in enumerate(columns)],
    )
    pairs = ", ".join(f"'{c}', null_{i}" for i, c in enumerate(columns))
    return counted.selectExpr(
        "row_count", f"stack({len(columns)}, {pairs}) as (column_name, null_count)"
    ).selectExpr(
        "column_name", "row_count", "null_count",
        "case when row_count > 0 then null_count / row_count else 1D end as null_rate",
    )


# Limits of the raw file contract.
MIN_FILE_ROWS = 100
MAX_NULL_RATE = 0.95


def file_contract(df: DataFrame, feed: str | None, min_rows: int = MIN_FILE_ROWS,
                  max_null_rate: float = MAX_NULL_RATE,
                  counts: tuple[int, Mapping[str, int]] | None = None) -> DataFrame:
    """Findings on a raw feed: (feed, finding, column_name, severity), none when it is sound.

    Unexpected columns only warn. An unknown feed is itself a finding. With ``counts``, the rows and the NULLs
    per column as file footers give them, no row of the frame is read.
    """
    spark = df.sparkSession
    shape = "feed string, finding string, column_name string, severity string"
    if feed is None or feed not in REQUIRED_COLUMNS:
        return spark.createDataFrame([(feed, "unknown_feed", None, CRITICAL)], shape)
    missing, unexpected = column_differences(df, feed, REQUIRED_COLUMNS, OPTIONAL_COLUMNS)
    present = [c for c in REQUIRED_COLUMNS[feed] if c not in missing]
    if counts is None:
        counted = df.agg(
            F.expr("count(1) as all_rows"),
            *[F.expr(f"count_if(`{c}` is null) as null_{i}") for i, c in enumerate(present)],
        )
    else:
        rows, nulls = counts
        counted = spark.range(1).selectExpr(
            f"{rows}L as all_rows", *[f"{nulls[c]}L as null_{i}" for i, c in enumerate(present)])

    def finding(kind: str, column: str | None, severity: str, applies: str = "true") -> str:
        name = f"'{column}'" if column else "cast(null as string)"
        return (f"named_struct('feed', '{feed}', 'finding', '{kind}', 'column_name', {name}, "
                f"'severity', '{severity}', 'applies', {applies})")

    found = [finding("missing_column", c, CRITICAL) for c in missing]
    found += [finding("unexpected_column", c, WARNING) for c in unexpected]
    found.append(finding("too_few_rows", None, CRITICAL, f"all_rows < {min_rows}"))
    # A file without rows counts as all NULL.
    found += [
        finding("mostly_null", c, CRITICAL,
                f"coalesce(try_divide(null_{i}, all_rows) > {max_null_rate}D, true)")
        for i, c in enumerate(present)
    ]
    return counted.selectExpr(f"inline(array({', '.join(found)}))").where("applies").drop("applies")


def contract_status(findings: DataFrame) -> DataFrame:
    """``ok`` or ``quarantine`` for a raw file, with its finding counts."""
    return findings.agg(
        F.expr(f"count_if(severity = '{CRITICAL}') as issues"),
        F.expr(f"count_if(severity = '{WARNING}') as warnings"),
    ).selectExpr("case when issues > 0 then 'quarantine' else 'ok' end as status", "issues", "warnings")


# Hours after which a source counts as late.
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 25, 49


def freshness(df: DataFrame, loaded_at: str, as_of: datetime | str, source: str,
              warn_hours: int = WARN_AFTER_HOURS, error_hours: int = ERROR_AFTER_HOURS) -> DataFrame:
    """Age of the newest row against the warning and error limits; no rows is an error."""
    return df.agg(F.expr(f"cast(max({loaded_at}) as timestamp_ntz) as newest")).selectExpr(
        "*", f"timestampdiff(SECOND, newest, cast('{as_of}' as timestamp_ntz)) as age_seconds"
    ).selectExpr(
        f"'{source}' as source", "newest", "age_seconds",
        f"case when age_seconds is null or age_seconds > {error_hours * 3600} then 'error' "
        f"when age_seconds > {warn_hours * 3600} then 'warn' else 'pass' end as status",
    )


# ---- column constraints of the marts ----------------------------------------

@dataclass(frozen=True)
class TableConstraints:
    """Constraints of one mart: never NULL, unique, limited to values, present in a parent."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


# The constraints declared for the marts.
CAB_TYPES = ("yellow", "green")
MART_CONSTRAINTS: dict[str, TableConstraints] = {
    "fact_trips": TableConstraints(
        not_null=("trip_id", "pickup_date", "pickup_at", "dropoff_at", "pickup_hour", "cab_type",
                  "pickup_location_id", "dropoff_location_id", "trip_distance_miles",
                  "trip_duration_seconds", "fare_amount", "total_amount"),
        unique=("trip_id",),
        accepted={
            "pickup_hour": tuple(range(24)),
            "cab_type": CAB_TYPES,
            "payment_type": ("Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip"),
        },
        references={"pickup_location_id": ("dim_location", "location_id"),
                    "dropoff_location_id": ("dim_location", "location_id")},
    ),
    "dim_location": TableConstraints(
        not_null=("location_id", "zone_name", "borough", "borough_group", "is_airport",
                  "is_manhattan_cbd"),
        unique=("location_id",),
        accepted={
            "borough": ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown",
                        "N/A"),
            "service_zone": ("Yellow Zone", "Boro Zone", "Airports", "EWR", "N/A"),
            "borough_group": ("Manhattan", "Outer boroughs", "Unknown / EWR"),
        },
    ),
    "dim_datetime": TableConstraints(
        not_null=("date_day", "year", "month", "day_of_week", "quarter", "is_weekend",
                  "is_us_holiday"),
        unique=("date_day",),
        accepted={"month": tuple(range(1, 13)), "day_of_week": tuple(range(1, 8)),
                  "quarter": (1, 2, 3, 4)},
    ),
    "mart_hourly_kpi": TableConstraints(
        not_null=("pickup_date", "pickup_hour", "cab_type", "borough_group", "trip_count",
                  "total_revenue", "is_weekend", "is_us_holiday"),
        accepted={"pickup_hour": tuple(range(24)), "cab_type": CAB_TYPES},
    ),
}


def constraint_checks(table: str) -> tuple[Check, ...]:
    """The row-level constraints of a mart as checks."""
    c = MART_CONSTRAINTS[table]
    return (
        *[Check(f"{table}.{n}.not_null", "not_null", n) for n in c.not_null],
        *[Check(f"{table}.{n}.accepted", "in_set", n, values=v) for n, v in c.accepted.items()],
    )


def constrained_columns(table: str) -> list[str]:
    """The columns that a mart's constraints look at."""
    c = MART_CONSTRAINTS[table]
    return list(dict.fromkeys((*c.not_null, *c.unique, *c.accepted, *c.references)))


def run_constraints(table: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every constraint of a mart as result rows: one shared pass, plus one pass for each unique key.

    References to a parent whose keys are measured small are looked up within the shared pass; one to a
    larger parent takes a pass of its own, which counts rows per key before the join. Hand it a
    written table: a lazy frame would be computed again for each pass.
    """
    c = MART_CONSTRAINTS[table]
    checks, shared, apart = list(constraint_checks(table)), df, []
    small: dict[tuple[str, str], bool] = {}
    for key, parent in c.references.items():
        known = (parents or {})[parent[0]].selectExpr(f"{parent[1]} as {key}", f"true as {_flag(key)}").distinct()
        if parent not in small:
            small[parent] = small_enough(known)
        if small[parent]:
            shared = dim_join(shared, known, key, small=True)
            checks.append(Check(f"{table}.{key}.relationship", "relationship", key))
        else:
            apart.append(check_reference(df, key, (parents or {})[parent[0]], parent[1], f"{table}.{key}.relationship"))
    frames = [run_suite(shared, checks)]
    frames += [check_unique(df, [k], f"{table}.{k}.unique") for k in c.unique]
    frames += apart
    return union_results(frames)


