"""Publication in one step: batches are written to fresh version directories and shown by the catalog entry.

A table's entry names, for each partition, the directory of the version that readers see. A batch
is written in full under a new version first; only then is the entry changed, by one catalog call a partition.
A reader that goes through the entry sees a partition before the batch or after it, never in between, and
a job that fails while writing leaves nothing visible. Earlier versions stay readable until they are dropped, so queries
that were planned before a publication can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions.trip import text_list
from curbline.schema import assert_additive
from curbline.sources.catalog import register_partition, register_table
from curbline.sources.readers import path_exists

PREFIX = "version-"


def create_published(spark: SparkSession, database: str, name: str, root: str, schema: T.StructType,
                     keys: Mapping[str, str]) -> None:
    """The entry of a table whose partitions are published below ``root``."""
    register_table(spark, database, name, root, schema, keys)


def write_version(batch: DataFrame, root: str, keys: Sequence[str]) -> str:
    """Write a batch by its keys to a new version directory that nothing refers to; returns the directory."""
    place = f"{root}/{PREFIX}{uuid.uuid4().hex}"
    batch.hint("rebalance", *keys).write.partitionBy(*keys).parquet(place)
    return place


def _directory(place: str, values: Mapping[str, int | str]) -> str:
    return place + "".join(f"/{k}={v}" for k, v in values.items())


def show_partition(spark: SparkSession, database: str, name: str, values: Mapping[str, int | str], place: str) -> None:
    """Point a partition of the entry at its directory in a written version: the one visible change."""
    register_partition(spark, database, name, values, _directory(place, values))


def publish_partition(batch: DataFrame, database: str, name: str, root: str,
                      values: Mapping[str, int | str], contract: T.StructType) -> str:
    """Replace one partition for readers of the entry; returns the version's directory.

    A row outside the partition fails the job before anything is visible. An empty batch publishes an empty
    partition. Columns may be added to the ``contract``, not changed.
    """
    assert_additive(contract, batch.schema)
    guarded = batch.withColumns({
        k: F.when(F.col(k) == v, F.col(k)).otherwise(F.raise_error(F.concat(
            F.lit(f"row outside {k}={v}: "), F.coalesce(F.col(k).cast("string"), F.lit("NULL")))))
        for k, v in values.items()
    })
    spark = batch.sparkSession
    place = write_version(guarded, root, list(values))
    if not path_exists(spark, _directory(place, values)):
        batch.drop(*values).limit(0).write.parquet(_directory(place, values))
    show_partition(spark, database, name, values, place)
    return place


def publish_new(batch: DataFrame, database: str, name: str, root: str, keys: Sequence[str]) -> str:
    """Publish partitions that the table does not have yet, all of them by one catalog call.

    The list of partitions is as long as the entry's own; a partition that is there already stops the call.
    """
    spark = batch.sparkSession
    place = write_version(batch, root, keys)
    found = spark.read.schema(batch.schema).parquet(place).select(*keys).distinct().collect()
    shown = [dict(zip(keys, r, strict=True)) for r in sorted(found)]
    if not shown:
        return place
    parts = " ".join(
        "PARTITION (" + ", ".join(f"`{k}`={text_list([v]) if isinstance(v, str) else v}" for k, v in p.items())
        + f") LOCATION {text_list([_directory(place, p)])}" for p in shown)
    spark.sql(f"ALTER TABLE `{database}`.`{name}` ADD {parts}")
    return place


def current_files(spark: SparkSession, database: str, name: str) -> list[str]:
    """The files that a reader of the entry opens."""
    spark.catalog.refreshTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}").inputFiles()


def stale_versions(spark: SparkSession, database: str, name: str, root: str) -> list[str]:
    """Version directories below ``root`` that no partition of the entry names any more."""
    full = f"`{database}`.`{name}`"
    used = set()
    for r in spark.sql(f"SHOW PARTITIONS {full}").collect():
        spec = ", ".join(f"`{k}`='{v}'" for k, v in (p.split("=", 1) for p in r[0].split("/")))
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {full} PARTITION ({spec})").where("col_name = 'Location'").first()
        used |= {part for part in about["data_type"].split("/") if part.startswith(PREFIX)}
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return sorted(f"{root}/{n}" for n in names if n.startswith(PREFIX) and n not in used)
