import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from curbline.llm import embeddings, simhash
from curbline.llm.components import components


def reach(n, pairs):
    """Lowest index reachable, by repeated passes."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_components(spark):
    pick = random.Random(3)
    n = 400
    pairs = [(i, i + 1) for i in range(60)] + [(pick.randrange(n), pick.randrange(n)) for _ in range(150)]
    pairs += [(399, i) for i in range(300, 340)]
    found = components(spark.createDataFrame([*pairs, *pairs[:9], (7, None)], "x long, y long"), "x", "y").collect()
    want = reach(n, pairs)
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == {
        i: want[i] for p in pairs for i in p if want.count(want[i]) > 1}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def plain_fingerprint(text):
    words = [w for w in __import__("re").findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(df, **more):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = reach(len(rows), pairs)
    least = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, float("inf")), float("inf") if doc_id is None else doc_id)
    want = sorted((i or -1, p, None if least[r] == float("inf") else least[r])
                  for (i, _), p, r in zip(rows, prints, root, strict=True))
    found = simhash.near_groups(df, **more).collect()
    assert sorted((r["doc_id"] or -1, r["fp"] % (1 << 64), r["component_id"]) for r in found) == want
    assert sum(r["kept"] for r in found) == len(least)


def test_simhash_of_documents(documents):
    check_simhash(documents)


def test_simhash_of_odd_rows(odd_documents, no_documents):
    check_simhash(odd_documents)
    assert simhash.near_groups(no_documents).count() == 0
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns


def clustered(pick, n):
    centres = [pick.getrandbits(64) for _ in range(4)] + [0]
    made = set()
    while len(made) < n:
        x = pick.choice(centres)
        for _ in range(pick.choice((0, 1, 2, 3, 4, 5))):
            x ^= 1 << pick.randrange(64)
        made.add(x)
    return sorted(made)


@pytest.mark.parametrize("bucket", [4096, 5])
def test_ball_hashing_finds_all_links(spark, bucket):
    prints = clustered(random.Random(bucket), 500)
    signed = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    found = components(simhash.links(spark.createDataFrame(signed, "fp long"), bucket, 20_000), "a", "b").collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    want = reach(len(prints), [(i, j) for i in range(len(prints)) for j in range(i)
                               if (prints[i] ^ prints[j]).bit_count() <= 3])
    groups = {}
    for r in found:
        groups.setdefault(r["component"], set()).add(place[r["node"]])
    expected = {}
    for i, r in enumerate(want):
        expected.setdefault(r, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_masked_keys_are_distinct(spark):
    keys = spark.range(1).select(simhash.masked_variants(F.lit(0x0123456789ABCDEF)).alias("k")).first()["k"]
    assert len(set(keys)) == len(keys) == 131


def check_vectors(df, **more):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]
    fit = [lab is not None and embeddings.usable(e) for _, lab, e in rows]
    n = len(rows)
    units = [np.asarray(e, float) / np.linalg.norm(np.asarray(e, float)) if f else None
             for (_, _, e), f in zip(rows, fit, strict=True)]
    links, pairs = [0] * n, []
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and rows[i][1] == rows[j][1] and len(units[i]) == len(units[j]) \
                    and units[i] @ units[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = reach(n, pairs)
    least = {}
    for (i, _, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, 1 << 60), i)
    found = embeddings.near_groups(df, **more).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == sorted(
        (i, k, least[r], i == least[r]) for (i, _, _), k, r in zip(rows, links, root, strict=True))


@pytest.mark.parametrize("sizes", [{}, {"per_cell": 8, "block": 4}])
def test_embeddings_against_all_pairs(spark, sizes):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    noise = np.random.default_rng(2)
    base = noise.standard_normal((6, 16))
    rows = [(10_000 + i, [float(x) for x in base[i % 6] + 0.25 * noise.standard_normal(16)], i % 2)
            for i in range(250)]
    rows += [(20_000 + i, rows[3][1], 1) for i in range(5)]
    near = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check_vectors(df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                            "label").unionByName(near), **sizes)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [], 1),
        (10, [1.0, 0.0, 0.0], 1), (11, [1e300, 1e299], 1), (12, [float("inf"), 0.0], 1), (13, [1e-300, 0.0], 1),
        (14, [-1.0, 0.0], 1), (15, [1.0, 0.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, node string")
    found = {(r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.near_groups(df).collect()}
    group = {1, 2, 3, 11, 13}
    assert found == {(i, 5 if i in group else 0, 1 if i in group else i) for i in range(1, 16)}
    assert embeddings.near_groups(df.limit(0)).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_no_table_or_batch_grows_with_the_meetings(spark, monkeypatch):
    """The best cells of these vectors leave most meetings open, and none may cost a further copy of a vector."""
    pick = np.random.default_rng(4)
    rows = [(i, [float(x) for x in pick.standard_normal(16)], 1) for i in range(2000)]
    held, write = {}, embeddings.written

    def weighed(df, label, **options):
        made = write(df, label, **options)
        sizes = [F.length(c) if kind == "binary" else F.size(c) * 8 for c, kind in made.dtypes
                 if kind in ("binary", "array<double>")]
        if sizes:
            held[label] = made.select(F.sum(sum(sizes))).first()[0]
        return made

    monkeypatch.setattr(embeddings, "written", weighed)
    check = embeddings.near_groups(vectors_of(spark, rows), per_cell=20, block=64)
    assert check.count() == 2000
    assert held and max(held.values()) <= 2000 * (16 * 8 + 32) * 1.5, held


@pytest.mark.parametrize("sizes", [{"per_cell": 16, "block": 24}, {"per_cell": 30, "block": 500}, {"per_cell": 400}])
def test_embeddings_of_small_labels_lengths_and_widths(spark, sizes):
    """Labels that share a group, two lengths of one label, floats beside doubles, -0.0, tight and loose groups."""
    pick = np.random.default_rng(6)
    made = []
    for label, n, dim in ((1, 150, 12), (1, 90, 5), (2, 60, 12), *((k, 4, 12) for k in range(3, 20))):
        base = pick.standard_normal((5, dim))
        for i in range(n):
            v = base[i % 5] + (0.02 if i % 2 else 0.3) * pick.standard_normal(dim)
            made.append((v.astype("f4").astype(float) if i % 3 else v, label))
    made += [(np.array([0.0, *made[0][0][1:]]), 1), (np.array([-0.0, *made[0][0][1:]]), 1)]
    rows = [(100 + i, [float(x) for x in v], label) for i, (v, label) in enumerate(made)]
    check_vectors(vectors_of(spark, rows), **sizes)


def test_projections_and_leading_products_lose_no_pair():
    pick = np.random.default_rng(8)
    for spread, dim in ((0.05, 24), (0.4, 24), (0.15, 90)):
        base = pick.standard_normal((12, dim))
        rows = embeddings.unit(base[pick.integers(0, 12, 900)] + spread * pick.standard_normal((900, dim)))
        centroids = embeddings.spherical_kmeans(rows, 20)
        cells = (rows @ centroids.T).argmax(1)
        layout = embeddings.Layout({}, {}, centroids, embeddings.strongest(rows, 0.93))

        def block(number, of, rows=rows, cells=cells, layout=layout, dim=dim):
            of = of[cells[of].argsort(kind="stable")]
            return embeddings.Block({
                "block": number, "dim": dim, "nodes": of.astype("<i8").tobytes(), "raw": rows[of].tobytes(),
                "copies": (of % 3 + 1).astype("<i8").tobytes(), "labels": (of % 2).astype("<i4").tobytes(),
                "cells": cells[of].astype("<i4").tobytes()}, layout)

        x, y = block(1, np.arange(0, 500)), block(2, np.arange(500, 900))
        near = (rows @ rows.T >= 0.93) & (np.arange(900)[:, None] % 2 == np.arange(900) % 2)
        np.fill_diagonal(near, False)
        for a, b, kept in ((x, x, near[:500, :500]), (x, y, near[:500, 500:])):
            found = embeddings.compare(a, b, layout, 0.93)
            links = dict(zip(found.column("node").to_pylist(), found.column("links").to_pylist(), strict=True))
            weight = np.arange(900) % 3 + 1
            left = kept @ weight[b.nodes[b.nodes.argsort()]]
            want = {i: int(n) for i, n in enumerate(left) if n}
            if a is not b:
                right = kept.T @ weight[:500]
                want |= {500 + i: int(n) for i, n in enumerate(right) if n}
            assert links == want and want
