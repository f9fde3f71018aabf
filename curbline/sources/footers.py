"""Row counts, bounds and null counts from Parquet footers: no column is read.

Spark's V2 file source answers counts, minima and maxima from the footers when aggregates are pushed down. Both
settings hold for the one read here and are put back after it. Bounds are pushed for numbers, dates and booleans,
whose footer statistics are exact; texts have counts only. A file whose column is all NULL keeps no bounds, and Spark
stops there: the bounds of that table are then read from its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.session import settings

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
_BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def _pushed(spark: SparkSession):
    return settings(spark, _SETTINGS)


def _counts(wanted: Sequence[T.StructField]) -> list:
    return [F.count(F.lit(1)), *(F.count(F.col(f"`{f.name}`")) for f in wanted)]


def _bounds(wanted: Sequence[T.StructField]) -> list:
    return [make(F.col(f"`{f.name}`")) for f in wanted if isinstance(f.dataType, _BOUNDED) for make in (F.min, F.max)]


def _fields(table: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    return [f for f in table.schema.fields if columns is None or f.name in columns]


def _first(spark: SparkSession, path: str, of: list) -> tuple:
    """One aggregate row, from the footers or, where a file has no bounds, from the columns."""
    try:
        with _pushed(spark):
            return tuple(spark.read.parquet(path).agg(*of).first())
    except (Py4JJavaError, PySparkException) as e:
        if "No min/max found" not in str(e):
            raise
    return tuple(spark.read.parquet(path).agg(*of).first())


def footer_plan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> str:
    """The physical plan of :func:`footer_profile`'s read."""
    with _pushed(spark):
        table = spark.read.parquet(path)
        wanted = _fields(table, columns)
        return table.agg(*_counts(wanted), *_bounds(wanted))._jdf.queryExecution().executedPlan().toString()


def footer_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; a pushed count of no rows is NULL."""
    return _first(spark, path, _counts(()))[0] or 0


def footer_counts(spark: SparkSession, path: str,
                  columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """Rows, and NULLs per column."""
    wanted = _fields(spark.read.parquet(path), columns)
    rows, *filled = (n or 0 for n in _first(spark, path, _counts(wanted)))
    return rows, {f.name: rows - n for f, n in zip(wanted, filled, strict=True)}


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: column_name, row_count, null_count, low, high (text; NULL where there is no exact bound)."""
    wanted = _fields(spark.read.parquet(path), columns)
    rows, *filled = (n or 0 for n in _first(spark, path, _counts(wanted)))
    bounded = [f.name for f in wanted if isinstance(f.dataType, _BOUNDED)]
    ends = _first(spark, path, _bounds(wanted)) if bounded else ()
    bounds = {name: (ends[2 * i], ends[2 * i + 1]) for i, name in enumerate(bounded)}

    def text(v):
        return v if v is None else str(v).lower() if isinstance(v, bool) else str(v)

    found = [(f.name, rows, rows - n, *map(text, bounds.get(f.name, (None, None))))
             for f, n in zip(wanted, filled, strict=True)]
    return spark.createDataFrame(found, "column_name string, row_count long, null_count long, low string, high string")
