"""Catalog entries for path-based tables, through Spark's own catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from curbline.functions.trip import text_list


def _ddl(schema: T.StructType, skip: Sequence[str] = ()) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in skip
    )


def _location(spark: SparkSession, full: str) -> str:
    """Where an entry's data lies, without the scheme."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").collect()
    return urlsplit(rows[0].data_type).path.rstrip("/") if rows else ""


def register_table(spark: SparkSession, database: str, name: str, path: str, schema: T.StructType,
                   keys: Mapping[str, str] | None = None) -> None:
    """Create the table entry, or bring its columns and location up to date; the data is not touched.

    Partition entries name places of their own, so an entry that moves is made
    anew; :func:`repair_table` then finds the partitions at the new place.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full = f"`{database}`.`{name}`"
    keys = dict(keys or {})
    if spark.catalog.tableExists(f"{database}.{name}") and _location(spark, full) != urlsplit(path).path.rstrip("/"):
        spark.sql(f"DROP TABLE {full}")
    if spark.catalog.tableExists(f"{database}.{name}"):
        have = {c.name.lower() for c in spark.catalog.listColumns(f"{database}.{name}")}
        fresh = T.StructType([
            f for f in schema.fields if f.name.lower() not in have and f.name not in keys
        ])
        if fresh.fields:
            spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({_ddl(fresh)})")
        return
    columns = _ddl(schema, tuple(keys))
    if keys:
        columns += ", " + ", ".join(f"`{k}` {t}" for k, t in keys.items())
    by = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{by} LOCATION {text_list([path])}")


def register_partition(spark: SparkSession, database: str, name: str, values: Mapping[str, int | str],
                       location: str | None = None) -> None:
    """Add a partition entry, or point an existing one at a new location.

    Numeric key text loses its leading zeros: month "03" is stored as 3.
    """
    full = f"`{database}`.`{name}`"
    plain = {k: int(v) if str(v).isdigit() else v for k, v in values.items()}
    spec = ", ".join(f"`{k}`={text_list([v]) if isinstance(v, str) else v}" for k, v in plain.items())
    place = f" LOCATION {text_list([location])}" if location else ""
    spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION ({spec}){place}")
    if location:
        spark.sql(f"ALTER TABLE {full} PARTITION ({spec}) SET LOCATION {text_list([location])}")


def repair_table(spark: SparkSession, database: str, name: str) -> None:
    """Pick up every partition directory found under the table's location."""
    spark.catalog.recoverPartitions(f"{database}.{name}")
