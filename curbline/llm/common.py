"""Shared by the operators: free column names, row keys, written scratch tables, Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame, name: str) -> DataFrame:
    """Adds a long that differs in every row. It is only stable once the result is written."""
    return df.withColumn(name, F.monotonically_increasing_id())


def rows_kept(staged: DataFrame, kept: DataFrame, row: str) -> DataFrame:
    """The rows of the written table ``staged`` whose unique key ``row`` is in ``kept``.

    A sort-merge join at every size, so that the plan of a small run is the plan of a large one: the
    list of rows grows with the documents and is not for broadcasting.
    """
    return staged.join(kept.hint("merge"), row, "left_semi")


def byte_values(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def extended(schema: pa.Schema, given: pa.RecordBatch, **more) -> pa.RecordBatch:
    """``given``'s columns followed by ``more``, under ``schema``."""
    added = [
        c if isinstance(c, pa.Array) else pa.array(c, schema.field(len(given.columns) + i).type)
        for i, c in enumerate(more.values())
    ]
    return pa.RecordBatch.from_arrays([*given.columns, *added], names=[*given.schema.names, *more])
