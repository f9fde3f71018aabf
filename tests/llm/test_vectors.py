"""op11 and op13 against plain Python on odd rows, and their numpy parts against full comparison."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import clustering, negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row string, distance string, numbers string"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(x) for x in pick.normal(0, 0.2, 8)], i % 3, "x", "y", "z") for i in range(120)]
    rows += [(i, list(rows[i - 200][1]), 1, None, None, None) for i in range(200, 220)]       # equal vectors, ties
    rows += rows[:4] + [rows[100]]                                                             # repeated rows
    rows += [
        (300, None, 1, None, None, None), (301, [], 1, None, None, None), (400, [0.0] * 8, 2, "a", "b", "c"),
        (302, [0.1] * 7 + [None], 1, None, None, None), (303, [0.1] * 7 + [math.nan], 1, None, None, None),
        (304, [0.1] * 7 + [math.inf], 0, None, None, None), (305, [1e30] * 8, 0, None, None, None),
        (None, [0.3] * 8, 1, None, None, None), (None, None, None, None, None, None),
        (306, [0.2] * 8, None, None, None, None), (500, [0.5] * 3, 1, None, None, None),
        (507, [0.5, 0.4, 0.4], 1, None, None, None), (508, [0.5, 0.4, 0.3], 0, None, None, None),
        (600, [-5e3] * 8, 0, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def whole_rows(df):
    for r in df.collect():
        e = r["embedding"]
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            v = [math.floor(256 * x) for x in e]
            if sum(x * x for x in v) <= vectors.LONGEST ** 2:
                yield r["vec_id"], r["label"], v


def plain_negatives(df, positives=5, negatives_=5):
    rows = [r for r in whole_rows(df) if r[1] is not None]
    made = []
    for a, (anchor, label, x) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        order = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i is None, i or 0, b, other)
                       for b, (i, other, y) in enumerate(rows) if b != a and len(y) == len(x))
        for score, none, i, _, _ in [o for o in order if o[4] == label][:positives]:
            fits = [o for o in order if o[4] != label and -80 * score <= -100 * o[0] <= -100 * score][:negatives_]
            made += [(anchor, None if none else i, rank, None if o[1] else o[2], -score, -o[0])
                     for rank, o in enumerate(fits, 1)]
    return made


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("blocks", [(512, 2048), (1, 17)])
def test_hard_negatives_of_odd_rows(spark, odd_vectors, blocks):
    found = negatives.hard_negatives(odd_vectors, F.col("vec_id") % 100 == 0, anchor_block=blocks[0], row_block=blocks[1])
    want = plain_negatives(odd_vectors)
    assert len(want) > 20 and listed(found) == sorted(want, key=str)


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0
    assert clustering.clusters(none).count() == 0


def test_threshold_join_finds_every_pair_and_omits_dimensions():
    pick = np.random.default_rng(5)
    for width, spread in ((1, 0), (3, 0), (40, 0.2), (64, 0)):
        y = np.rint(pick.normal(0, 30, (300, width)) * np.exp(-spread * np.arange(width))).astype(np.int64)
        x = y[pick.integers(0, 300, 40)] + pick.integers(-3, 4, (40, width))
        full = x @ y.T
        for share in (0.9, 0.4, -0.5, None):
            least = np.full(40, -np.inf) if share is None else share * (x.astype(float) ** 2).sum(1)
            i, j, score = negatives.reaching(x, least, y)
            want = np.argwhere(full >= least[:, None])
            assert sorted(zip(i, j, strict=True)) == [tuple(p) for p in want]
            assert (score == full[i, j]).all()
    assert negatives.reaching(np.zeros((0, 3), int), np.zeros(0), np.ones((2, 3), int))[0].size == 0


def plain_clusters(df, k, rounds, width, seed=2):
    kept = [(i, v) for i, _, v in whole_rows(df) if len(v) == width]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))
                for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == n]
            if own:
                centroids[n] = [math.floor(Fraction(sum(x), len(own))) for x in zip(*own, strict=True)]
    near = assign()
    inertia = [sum(d for d, c in near if c == n) for n in range(len(centroids))]
    return [(i, c, d, inertia[c], sum(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for (i, _), (d, c) in zip(kept, near, strict=True)]


@pytest.mark.parametrize(("k", "rounds"), [(40, 5), (5, 3), (1000, 1), (1, 0)])
def test_clusters_of_odd_rows(spark, odd_vectors, k, rounds):
    found = clustering.clusters(odd_vectors, k=k, rounds=rounds, width=8).drop("met")
    assert listed(found) == sorted(plain_clusters(odd_vectors, k, rounds, 8), key=str)


def test_walk_stops_early_and_breaks_ties_by_number():
    pick = np.random.default_rng(0)
    for n, k, dims in ((3000, 40, 2), (500, 40, 64), (50, 3, 1), (50, 1, 5)):
        rows, centroids = pick.integers(-60, 60, (n, dims)), pick.integers(-60, 60, (k, dims))
        centroids[k // 2] = centroids[0]
        full = ((rows[:, None] - centroids[None]) ** 2).sum(2)
        cluster, distance, met = clustering.SortedLists(centroids).nearest(rows)
        assert (cluster == full.argmin(1)).all() and (distance == full.min(1)).all()
        if dims == 2:
            assert met.mean() < k / 2
