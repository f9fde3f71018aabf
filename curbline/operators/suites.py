"""Check suites as data: a JSON document, typed by ``from_json``, validated as rows, turned into checks.

    {"suite": "trips", "checks": [
      {"check_id": "C1", "kind": "between", "column": "fare", "low": 0, "high": 9, "mostly": 0.99, "severity": "WARNING"}]}

``severity`` is CRITICAL and ``mostly`` 1 where absent; ``values`` are texts, which Spark casts to the column's type.
A suite is as long as its author made it, so its checks, not the rows they look at, come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.trip import text_list
from curbline.operators.quality import CRITICAL, WARNING, Check

CHECK_FIELDS = {
    "check_id": "string", "kind": "string", "column": "string", "low": "double", "high": "double",
    "values": "array<string>", "mostly": "double", "severity": "string", "metric": "string", "month": "date",
}
_TYPED = f"suite string, checks array<struct<{', '.join(f'{n}: {t}' for n, t in CHECK_FIELDS.items())}>>"
# The same document with every value as its own text: what was there before types were put on it.
_PLAIN = "suite string, checks array<map<string, string>>"

# kind -> what it needs; a kind on a column needs the column as well.
_NEEDS = {
    "row_count": "low is not null or high is not null",
    "not_null": "true",
    "between": "low is not null or high is not null",
    "in_set": "size(values) > 0 and not exists(values, v -> v is null)",
    "in_month": "month is not null",
    "mean_between": "low is not null or high is not null",
}


def parsed_checks(text: DataFrame, column: str = "value") -> DataFrame:
    """One row per check of a suite text: its place, its typed fields and ``problems``, an array of texts."""
    both = text.select(
        F.from_json(column, _TYPED).alias("typed"), F.from_json(column, _PLAIN).alias("plain"))
    rows = both.selectExpr("posexplode_outer(plain.checks) as (place, given)", "typed.checks as typed").selectExpr(
        "coalesce(place + 1, 0) as place", "given", "inline_outer(array(get(typed, place)))")
    known = text_list(CHECK_FIELDS)
    needs = " ".join(f"when '{kind}' then {rule}" for kind, rule in _NEEDS.items())
    tests = {
        "'no check_id'": "coalesce(check_id, '') = ''",
        "concat('check_id ', check_id, ' twice')": "twice",
        "concat('unknown kind ', coalesce(kind, 'NULL'))": f"coalesce(kind, '') not in ({text_list(_NEEDS)})",
        "concat('kind ', kind, ' lacks its limits')": f"not (case kind {needs} else true end)",
        "'no column'": "coalesce(kind, 'row_count') <> 'row_count' and coalesce(column, '') = ''",
        "concat('severity ', severity)": f"severity not in ('{CRITICAL}', '{WARNING}')",
        "'mostly outside 0 to 1'": "not (mostly between 0 and 1)",
        "'low above high'": "low > high",
        "concat('unknown fields ', array_join(array_sort(array_except(map_keys(given), array("
        f"{known}))), ', '))": f"size(array_except(map_keys(given), array({known}))) > 0",
    }
    # A value that is there as text and gone once typed was of another type.
    tests |= {f"'{name} is no {kind}'": f"given['{name}'] is not null and {name} is null"
              for name, kind in CHECK_FIELDS.items() if kind != "string"}
    found = ", ".join(f"case when {when} then {what} end" for what, when in tests.items())
    return rows.selectExpr(
        "*", "coalesce(count(1) over (partition by check_id) > 1 and check_id is not null, false) as twice"
    ).selectExpr("place", *CHECK_FIELDS,
                 f"case when given is null then array('no checks') else array_compact(array({found})) end as problems")


def checks_of(text: DataFrame, column: str = "value") -> tuple[Check, ...]:
    """The checks of a suite text, in its order; raises with every problem of every check named.

    A text that is no JSON, or has no check, raises as well.
    """
    rows = parsed_checks(text, column).orderBy("place").collect()
    problems = [f"check {r.place} ({r.check_id}): {p}" for r in rows for p in r.problems]
    if problems or not rows:
        raise ValueError("suite not usable: " + "; ".join(problems or ["no text"]))
    return tuple(
        Check(r.check_id, r.kind, r.column, r.low, r.high, tuple(r["values"] or ()),
              1.0 if r.mostly is None else r.mostly, r.severity or CRITICAL, r.metric, r.month)
        for r in rows
    )


def parse_suite(spark: SparkSession, text: str) -> tuple[Check, ...]:
    return checks_of(spark.createDataFrame([(text,)], "value string"))


def read_suite(spark: SparkSession, path: str) -> tuple[Check, ...]:
    """A suite from one JSON file, on any file system Spark reads."""
    return checks_of(spark.read.text(path, wholetext=True))


def shipped_suite(spark: SparkSession, name: str = "trips") -> tuple[Check, ...]:
    """A suite that comes with the package."""
    return parse_suite(spark, files("curbline.operators").joinpath(f"suite_{name}.json").read_text("utf-8"))


def missing_columns(df: DataFrame, checks: Sequence[Check]) -> list[str]:
    """Columns that checks look at and the frame does not have."""
    have = {c.lower() for c in df.columns}
    return sorted({c.column for c in checks if c.column and c.column.lower() not in have})
