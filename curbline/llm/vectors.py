"""Vectors of whole numbers: ``floor(256 * x)`` of every component x, taken as a double."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: A scaled vector longer than this takes no part: products and squared distances of shorter ones fit a long.
LONGEST = float(2 ** 30)


def scaled(embedding: Column) -> Column:
    return F.transform(embedding.cast("array<double>"), lambda x: x * SCALE)


def usable(embedding: Column) -> Column:
    """Whether the vector has only finite components and a scaled length of at most ``LONGEST``."""
    square = F.aggregate(scaled(embedding), F.lit(0.0), lambda total, x: total + x * x)
    return F.coalesce(square <= LONGEST * LONGEST, F.lit(False))  # NaN compares above any number


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """The usable rows as (vec_id, label, numbers): array<bigint>; other columns are dropped."""
    return vectors.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(scaled(F.col("embedding")), lambda x: F.floor(x)).alias("numbers"))


def matrix(numbers: pa.Array, width: int) -> np.ndarray:
    """A batch's vectors, all of length ``width``, as rows."""
    return numbers.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
