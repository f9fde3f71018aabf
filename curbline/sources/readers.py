"""Scans: raw feed directories, month-partitioned tables, reference CSV, literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions.trip import text_list

# Layout of the zone lookup file.
ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType(), True),
    T.StructField("Borough", T.StringType(), True),
    T.StructField("Zone", T.StringType(), True),
    T.StructField("service_zone", T.StringType(), True),
])

# Payment and rate code tables.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]

# Feed names as they begin a file name, longest spelling first.
FEED_PREFIXES = ("fhvhv", "fhv", "green", "yellow")


def raw_month_path(root: str, feed: str, year: int, month: int) -> str:
    return f"{root}/bronze/{feed}/{year:04d}-{month:02d}"


def read_feed(spark: SparkSession, root: str, feed: str, year: int, month: int) -> DataFrame:
    """One feed's raw month: ``root/bronze/<feed>/<YYYY-MM>/``."""
    return spark.read.parquet(raw_month_path(root, feed, year, month))


def read_month(
    spark: SparkSession, path: str, year: int, month: int,
    keys: Sequence[str] = ("pickup_year", "pickup_month"),
) -> DataFrame:
    """One month of a table partitioned by (year, month).

    The month's directory is opened by name, so that the cost of listing files
    and merging their schemas does not grow with the table's history.
    """
    leaf = f"{path}/{keys[0]}={year}/{keys[1]}={month}"
    if not path_exists(spark, leaf):
        return read_evolved(spark, path).where((F.col(keys[0]) == year) & (F.col(keys[1]) == month))
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(leaf)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below a path; none where the path is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(place) if files.exists(place) else []
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose columns grew over time; older files give NULL for newer columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header; types are declared, never inferred."""
    return spark.read.schema(ZONE_SCHEMA).option("header", "true").csv(path)


def load_seed(zones: DataFrame) -> DataFrame:
    """The zone lookup under the names the marts use."""
    return zones.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


def lookup_table(spark: SparkSession, rows: Sequence[tuple], key: str, label: str) -> DataFrame:
    """A literal (long key, string label) table, held in the plan itself."""
    values = ", ".join(f"({int(k)}L, {text_list([v])})" for k, v in rows)
    return spark.sql(f"select * from values {values} as t({key}, {label})")


def payment_types(spark: SparkSession, key: str = "payment_type",
                  label: str = "payment_type_name") -> DataFrame:
    return lookup_table(spark, PAYMENT_TYPES, key, label)


def rate_codes(spark: SparkSession, key: str = "rate_code_id",
               label: str = "rate_code_desc") -> DataFrame:
    return lookup_table(spark, RATE_CODES, key, label)


def feed_from_file_name(file_name: str = "_metadata.file_name"):
    """Feed named by the start of a file name; NULL where none fits."""
    found = F.regexp_extract(F.col(file_name), f"^({'|'.join(FEED_PREFIXES)})", 1)
    return F.nullif(found, F.lit(""))


def file_manifest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The data files behind a table frame, one row per (partition keys, file)."""
    return df.select(*keys, F.col("_metadata.file_path").alias("file_path")).distinct()


def file_listing(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """Every data file below a path with its size and partition keys, files without rows included.

    The files are listed, in parallel for many directories, and none is opened.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path).drop(
        "content").withColumnsRenamed({"path": "file_path", "length": "bytes", "modificationTime": "modified_at"})
