"""Centroid clustering whose nearest centroid is found by the threshold algorithm.

Every dimension keeps the centroids' values in order. From a vector's own value the lists are walked
outwards, in all dimensions at the same pace, the nearer neighbour first; a centroid met for the first
time gets its exact squared distance. A centroid not met yet is at least as far away as the
frontiers of all lists together, so the walk of a vector stops when the sum of the squared frontier
distances strictly exceeds its best exact distance (or when every centroid has been met). Strictly, since a
tie goes to the smaller number and a tied centroid may still be unmet.

A batch of vectors walks in step: numpy holds one pair of list positions per vector and dimension,
and vectors that stopped leave the arrays. The work is done where Spark dealt the rows; a task sends
one sum and count per centroid, which Spark adds up, so at most ``k`` centroids reach the driver each
round. Sums are exact.

Vectors take part when they have ``width`` finite components and a scaled length of at most 2 ** 30 (see
``vectors``; longer ones would not fit the distance column) and are left out otherwise. With fewer than ``k``
of them every one is a centroid. A null id is hashed as an empty id, and ties of hash go by the
numbers. Repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, written
from curbline.llm.vectors import matrix, whole_vectors

_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("met", pa.int32())])
_SUMS = pa.schema([("cluster", pa.int32()), ("total", pa.list_(pa.int64())), ("n", pa.int64())])
#: Vectors that walk together; bounds a task's arrays whatever the size of an Arrow batch.
TOGETHER = 2048


class SortedLists:
    """The centroids' values of every dimension in order, with the centroid of each place."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        far = np.iinfo(np.int64).max
        values = np.take_along_axis(centroids.T, self.order, axis=1)
        edge = np.full((len(values), 1), far)
        # A place before the first and one behind the last value: nothing lies there.
        self.values = np.concatenate([edge, values, edge], axis=1)
        self.order = np.pad(self.order, ((0, 0), (1, 1)), constant_values=-1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the nearest centroid, its squared distance, and how many centroids were met."""
        parts = [self._walk(rows[i:i + TOGETHER]) for i in range(0, len(rows), TOGETHER)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _walk(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, dims = rows.shape
        k = len(self.centroids)
        far = np.iinfo(np.int64).max
        distance = np.full((n, k), far)
        active = np.arange(n)
        axis = np.arange(dims)
        # The first place on the right whose value is not below the row's.
        right = np.stack([1 + np.searchsorted(self.values[d, 1:-1], rows[:, d]) for d in axis], axis=1)
        left = right - 1
        for _ in range(k):
            own = rows[active]
            to_left, to_right = self._gap(own, left), self._gap(own, right)
            go_left = to_left <= to_right
            met = np.zeros((len(active), k), bool)
            met[np.arange(len(active))[:, None], self.order[axis, np.where(go_left, left, right)]] = True
            i, c = np.nonzero(met & (distance[active] == far))
            distance[active[i], c] = ((rows[active[i]] - self.centroids[c]) ** 2).sum(1)
            left, right = left - go_left, right + ~go_left
            # A list's frontier is the gap of the value taken last: all others are at least as far out.
            frontier = np.minimum(to_left, to_right).astype(float)
            best = distance[active].min(1)
            open_ = ((frontier * frontier).sum(1) <= best * (1 + 1e-12)) & (distance[active] == far).any(1)
            active, left, right = active[open_], left[open_], right[open_]
            if not len(active):
                break
        return distance.argmin(1).astype(np.int32), distance.min(1), (distance < far).sum(1).astype(np.int32)

    def _gap(self, own: np.ndarray, place: np.ndarray) -> np.ndarray:
        values = self.values[np.arange(own.shape[1]), place]
        far = np.iinfo(np.int64).max
        return np.where(values == far, far, np.abs(np.where(values == far, 0, values) - own))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of seed and id; each task keeps its own ``k`` first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["numbers"]) for r in kept.select(digest.alias("digest"), "numbers").orderBy(
        "digest", "numbers").limit(k).collect()]


def _sums(centroids: list[list[int]]):
    width = len(centroids[0])

    def run(batches):
        lists = SortedLists(np.array(centroids, np.int64).reshape(-1, width))
        totals = np.zeros((len(centroids), width), np.int64)
        counts = np.zeros(len(centroids), np.int64)
        for given in batches:
            rows = matrix(given.column(0), width)
            if len(rows):
                cluster, _, _ = lists.nearest(rows)
                np.add.at(totals, cluster, rows)
                counts += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(counts)
        yield batch(_SUMS, used.tolist(), totals[used].tolist(), counts[used].tolist())

    return run


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the floor of each cluster's mean; a centroid without vectors stays."""
    parts = kept.select("numbers").mapInArrow(_sums(centroids), "cluster int, total array<bigint>, n bigint")
    places = parts.select("cluster", "n", F.posexplode("total").alias("dim", "part"))
    # Decimals of 38 digits hold any sum of longs that a table can have.
    means = places.groupBy("cluster", "dim").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    new = [list(c) for c in centroids]
    for r in means.collect():  # at most k * width rows
        new[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return new


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, seed: int = 2) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, met, cluster_inertia, inertia, centroid_sha256.

    ``met`` is the number of centroids whose exact distance was needed. An inertia that no long holds is null.
    """
    spark = vectors.sparkSession
    kept = written(whole_vectors(vectors).where(F.size("numbers") == width).select("vec_id", "numbers"), "whole")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids)

    def assign(batches):
        lists = SortedLists(np.array(centroids, np.int64).reshape(-1, width))
        for given in batches:
            rows = matrix(given.column(1), width)
            if len(rows):
                yield batch(_ASSIGNED, given.column(0), *lists.nearest(rows))

    placed = written(kept.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint, met int"), "assigned")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    fits = {r["cluster"]: int(r["total"]) for r in sums}  # at most k rows
    whole = sum(fits.values())
    most = 2 ** 63 - 1
    rows = [(c, v if v <= most else None, whole if whole <= most else None,
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, v in fits.items()]
    about = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(  # k short rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "met")
