"""Table writes: partition replacement, incremental overwrite, quarantine, reports.

Partition overwrites use Spark's dynamic mode, which stages the new files and
swaps whole partition directories when the job commits. A job that fails before
its commit leaves the table as it was; the swap itself is a delete and a rename per
partition, so a failure there can lose a partition, which writing the batch again
mends. The setting is passed per write, never set on the session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.schema import assert_additive
from curbline.session import settings
from curbline.sources.readers import path_exists, read_evolved

# A write into many directories costs by the file, not by the byte: small shuffles keep their tasks.
# Where tasks hold more than Spark's own lower bound of 1 MB, nothing changes.
_BY_FILE = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where nothing has been written yet."""
    if not path_exists(spark, path):
        return None
    try:
        return read_evolved(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def check_evolution(df: DataFrame, path: str, contract: T.StructType | None = None) -> None:
    """Stop before writing a batch that would change a column's type.

    Against a declared contract this costs nothing; without one the schemas of
    the table's files are merged, which takes longer the more files there are.
    """
    if contract is not None:
        assert_additive(contract, df.schema)
        return
    table = existing_table(df.sparkSession, path)
    if table is not None:
        assert_additive(table.schema, df.schema)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite",
                      fmt: str = "parquet") -> None:
    """Hive-style directories by key columns.

    ``rebalance`` gathers a partition's rows into few files, while adaptive
    execution splits a large one over several tasks.
    """
    with settings(df.sparkSession, _BY_FILE):
        df.hint("rebalance", *keys).write.format(fmt).mode(mode).partitionBy(*keys).save(path)


def replace_partition(df: DataFrame, path: str, where: Mapping[str, int | str],
                      contract: T.StructType | None = None, fmt: str = "parquet") -> int:
    """Replace exactly the partition named by ``where``; returns the rows written.

    A row outside the partition fails the job before anything is swapped. An
    empty batch empties the partition, which dynamic overwrite alone would not.
    """
    check_evolution(df, path, contract)
    guarded = df.withColumns({
        k: F.when(F.col(k) == v, F.col(k)).otherwise(
            F.raise_error(F.concat(F.lit(f"row outside {k}={v}: "),
                                   F.coalesce(F.col(k).cast("string"), F.lit("NULL"))))
        )
        for k, v in where.items()
    })
    seen = Observation()
    (
        guarded.hint("rebalance")
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*where)
        .save(path)
    )
    written = seen.get["rows"]
    if not written:
        leaf = "/".join(f"{k}={v}" for k, v in where.items())
        df.drop(*where).limit(0).write.format(fmt).mode("overwrite").save(f"{path}/{leaf}")
    return written


def insert_overwrite(df: DataFrame, path: str, keys: Sequence[str], contract: T.StructType | None = None,
                     fmt: str = "parquet", dealt: bool = False,
                     behind: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace the partitions present in the batch; every other one stays.

    ``dealt`` tells that no partition lies in several tasks, so that no shuffle is added. ``behind`` is applied to
    the rows once they are dealt, so that columns it adds do not cross the shuffle; it must keep each row and its keys.
    """
    rows = df if dealt else df.hint("rebalance", *keys)
    if behind:
        rows = behind(rows)
    check_evolution(rows, path, contract)
    with settings(df.sparkSession, _BY_FILE):
        (
            rows.write.format(fmt).mode("overwrite")
            .options(**({"compression": "zstd"} if fmt == "parquet" else {}))
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .save(path)
        )


def materialize(df: DataFrame, name: str, mode: str, path: str | None = None,
                keys: Sequence[str] = (), full_refresh: bool = False) -> None:
    """Publish a model as a ``view``, a ``table`` or an ``incremental`` table."""
    if mode == "view":
        df.createOrReplaceTempView(name)
        return
    writer = df.write.format("parquet")
    if path:
        writer = writer.option("path", path)
    if mode == "table" or full_refresh:
        if keys:
            writer = writer.partitionBy(*keys)
        writer.mode("overwrite").saveAsTable(name)
    elif mode == "incremental":
        if not path:
            raise ValueError("an incremental model needs the path of its table")
        insert_overwrite(df, path, keys)
        if not df.sparkSession.catalog.tableExists(name):
            df.sparkSession.catalog.createTable(name, path, "parquet")
        if keys:
            df.sparkSession.catalog.recoverPartitions(name)
    else:
        raise ValueError(f"unknown materialisation {mode!r}")


def write_manifest(manifest: DataFrame, path: str, keys: Sequence[str]) -> None:
    """File lists as text, one directory per partition."""
    manifest.select(*keys, "file_path").write.mode("overwrite").partitionBy(*keys).text(path)


def quarantine(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Copy failed rows aside under their own keys; the source is left alone."""
    insert_overwrite(df, path, keys)


def write_report(results: DataFrame, path: str, suite: str, partition: date | str) -> None:
    """Check results as JSON lines, one directory per checked partition."""
    (
        results.withColumn("suite", F.lit(suite)).withColumn("partition", F.lit(str(partition)))
        .coalesce(1)
        .write.mode("overwrite").json(f"{path}/partition={partition}")
    )
