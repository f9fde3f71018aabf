"""Near dedup of a corpus by the share of common shingles, found by SimHash balls and MinHash bands and verified exactly.

A text (null: empty) is the set of its runs of ``words`` words, cut as in ``simhash``; texts whose sets
have a Jaccard similarity of ``similarity`` or more are near copies. Candidates are texts whose fingerprints over
these shingles lie within three bits, found by meet-in-the-middle ball hashing as in ``simhash``. Fingerprints of most
near copies differ in more bits, so texts that agree in one of ``BANDS`` keys of ``ROWS`` MinHash values each are
candidates as well. A pair at 0.8 is missed by all keys with probability 6e-5, a closer one more rarely; no key,
text or pair is left out beyond that.

Equal sets are collapsed first. Then every text of a key is compared with one of them, which joins a
large group without looking at its pairs. Texts of keys that hold several groups after that go through an exact
prefix filter: a pair of sizes m and n at the similarity shares at least s (m + n) / (1 + s) shingles, so it shares one
of the first few when all shingles are put in one order, rare ones first. Texts that differ by edits of their own
begin with those edits and meet nowhere. Sizes are dealt into classes ``STEP`` wide, so that the number of first
shingles fits the partner's size. Each comparison counts the common shingles.

Near copies are linked and one document of each component stays: the smallest ``doc_id``, then row; null
ids come last. An empty table gives an empty result; all columns stay as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import batch, byte_values, fresh, rows_kept, with_row, written
from curbline.llm.components import components
from curbline.llm.simhash import links as fingerprint_links
from curbline.llm.simhash import majority, shingle_hashes

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 6
#: Sizes of one class of the prefix filter differ by less than this factor.
STEP = 1.04
_random = np.random.default_rng(8)
_XOR = _random.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
_FACTOR = _random.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_SKETCH = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("same", pa.binary()), ("size", pa.int32()),
                     ("keys", pa.list_(pa.int64())), ("print", pa.int64())])
_SETS = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
_SHINGLE = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes in order."""
    return np.unique(shingle_hashes(text, words))


def similar(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def band_keys(shingles: np.ndarray) -> list[int]:
    """The key of every band as a signed int; none for an empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        least = np.minimum(least, ((shingles[at:at + 1024] ^ _XOR) * _FACTOR).min(axis=1))
    made = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(made, np.uint64).view(np.int64).tolist()


def _sketches(texts: DataFrame, words: int) -> DataFrame:
    """From (doc_id, node, text): doc_id, node, digest of the set, its size, its keys and the text's fingerprint."""
    def run(batches):
        for given in batches:
            sets, prints = [], []
            for text in byte_values(given.column(2)):
                hashes = shingle_hashes(text, words)
                sets.append(np.unique(hashes))
                prints.append(majority(hashes))
            yield batch(_SKETCH, given.column(0), given.column(1), [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                        [len(s) for s in sets], [band_keys(s) for s in sets], np.array(prints, np.uint64).view(np.int64))

    return texts.mapInArrow(run, "doc_id bigint, node bigint, same binary, size int, keys array<bigint>, print bigint")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """From (node, text): node and its set as bytes."""
    def run(batches):
        for given in batches:
            yield batch(_SETS, given.column(0), [shingle_set(t, words).tobytes() for t in byte_values(given.column(1))])

    return texts.mapInArrow(run, "node bigint, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    def run(batches):
        for given in batches:
            left, right = (c.to_pylist() for c in given.columns[2:])
            near = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity
                    for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(list(given.columns[:2]), schema=_EDGE).filter(pa.array(near, pa.bool_()))

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def _pair(similarity: float, one: str, two: str, size: str, other: str) -> tuple[list[Column], Column]:
    """The pair's nodes in order, and whether their sizes allow the similarity."""
    fits = F.least(size, other) >= F.greatest(size, other) * (similarity - 1e-9)
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")], fits


def size_class(size: Column) -> Column:
    return F.floor(F.log(size) / math.log(STEP))


def meeting(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, size, component) of different components that share a shingle of their
    prefixes and have sizes that allow the similarity; every pair at the similarity is among them."""
    def run(batches):
        for given in batches:
            each = [np.frombuffer(v, np.int64) for v in given.column(1).to_pylist()]
            yield batch(_SHINGLE, np.repeat(given.column(0).to_numpy(), [len(v) for v in each]),
                        np.concatenate(each) if each else [])

    single = written(sets.mapInArrow(run, "node bigint, shingle bigint"), "single")
    times = written(single.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    # A shingle of one text meets nothing; it comes first in the order and is counted, not sent.
    shared = single.join(times, "shingle").select("node", "shingle", "times")
    sized = nodes.select("node", "size", "component", size_class(F.col("size")).alias("own"))
    own = Window.partitionBy("node").orderBy("times", "shingle")
    alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    ranked = shared.join(sized, "node").withColumn("place", F.row_number().over(own) + alone)
    low = size_class(F.col("size") * similarity) - 1
    high = size_class(F.col("size") / similarity) + 1

    def prefix(size: Column, other: Column) -> Column:
        """Length of a prefix towards a text of size ``other``; the margin covers rounding."""
        return size - F.ceil((size + other) * (similarity / (1 + similarity)) - 1e-6) + 1

    # The prefix towards a class follows from the smallest size in it.
    classes = F.filter(F.sequence(low, high), lambda k: F.col("place") <= prefix(
        F.col("size"), F.pow(F.lit(STEP), k) * (1 - 1e-9)))
    placed = ranked.select("node", "size", "component", "own", "shingle", "place", F.explode(classes).alias("k")).select(
        "node", "size", "component", "own", "shingle", "place", F.least("own", "k").alias("low"),
        F.greatest("own", "k").alias("high"))
    placed = written(placed, "prefixes")
    key = ["shingle", "low", "high"]
    met = written(placed.groupBy(*key).agg(F.min("component").alias("one"), F.max("component").alias("two")).where(
        "one < two").select(*key), "met")
    met = written(placed.join(met, key, "left_semi"), "meeting")
    other = met.select(*key, *(F.col(c).alias(f"{c}_b") for c in ("node", "size", "component", "own", "place")))
    columns, fits = _pair(similarity, "node", "node_b", "size", "size_b")
    size, size_b = F.col("size"), F.col("size_b")
    in_both = (F.col("place") <= prefix(size, size_b)) & (F.col("place_b") <= prefix(size_b, size))
    return met.join(other, key).where((F.col("component") < F.col("component_b")) & fits & in_both & (
        (F.col("low") == F.col("high")) | (F.col("own") != F.col("own_b")))).select(*columns).distinct()


def ball_pairs(sets_of: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of ``sets_of`` (node, size, print) that connect fingerprints within three bits of each other, as far
    as sizes allow the similarity; texts of one fingerprint are paired with one of them."""
    prints = written(sets_of.groupBy("print").agg(F.min(F.struct("node", "size")).alias("first")).select(
        F.col("print").alias("fp"), F.col("first.node").alias("first"), F.col("first.size").alias("first_size")), "prints")
    columns, fits = _pair(similarity, "node", "first", "size", "first_size")
    edges = fingerprint_links(prints.select("fp"))
    one = prints.select(F.col("fp").alias("a"), F.col("first").alias("node"), F.col("first_size").alias("size"))
    between = edges.join(one, "a").join(prints.withColumnRenamed("fp", "b"), "b").select("node", "size", "first", "first_size")
    equal = sets_of.join(prints, F.col("print") == F.col("fp")).where(F.col("node") != F.col("first"))
    return written(between.unionByName(equal.select(*between.columns)).where(fits).select(*columns).distinct(), "balls")


def links(sets_of: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Edges (a, b) that connect similar sets; ``sets_of`` has (node, size, keys, print), ``texts`` (node, text)."""
    balls = ball_pairs(sets_of.select("node", "size", "print"), similarity)
    keyed = sets_of.select("node", "size", F.explode("keys").alias("key"))
    # A key's leader differs from key to key, as its texts are ordered anew.
    leader = F.min(F.struct(F.xxhash64("key", "node").alias("order"), "node", "size")).alias("leader")
    keyed = written(keyed, "keys")
    leaders = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), leader).where("n > 1").select(
        "key", F.col("leader.node").alias("first"), F.col("leader.size").alias("first_size")), "leaders")
    shared = written(keyed.join(leaders, "key"), "shared")
    compared = shared.select("node").union(balls.select("a")).union(balls.select("b")).distinct()
    sets = written(_sets(rows_kept(texts, compared, "node"), words), "shingles")

    columns, fits = _pair(similarity, "node", "first", "size", "first_size")
    stars = written(shared.where((F.col("node") != F.col("first")) & fits).select(*columns).unionByName(balls).distinct(), "stars")
    found = written(_verified(stars, sets, similarity), "star-links")

    groups = shared.select("key", "node", "size").join(components(found, "a", "b"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    groups = written(groups, "groups")
    mixed = written(groups.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low < high").select("key"), "mixed")
    open_keys = written(groups.join(mixed, "key", "left_semi"), "open")
    nodes = written(open_keys.select("node", "size", "component").distinct(), "open-nodes")
    rest = meeting(nodes, rows_kept(sets, nodes.select("node"), "node"), similarity)
    rest = written(rest.join(stars, ["a", "b"], "left_anti"), "rest")
    return found.unionByName(_verified(rest, sets, similarity))


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group of near copies; all columns stay as they are."""
    row = fresh(docs, "row_key")
    staged = written(with_row(docs, row), "staged")
    texts = staged.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("node"),
                          F.col("text").cast("string").alias("text"))
    sketches = written(_sketches(texts, words), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("node"))
    distinct = written(sketches.groupBy("same").agg(
        F.min(order).alias("least"), F.any_value("size").alias("size"), F.any_value("keys").alias("keys"),
        F.min("print").alias("print")).select(
        F.col("least.node").alias("node"), "least", "size", "keys", "print"), "distinct")
    joined = components(links(distinct.select("node", "size", "keys", "print"), texts.select("node", "text"), words,
                              similarity), "a", "b")
    labelled = distinct.select("node", "least").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    kept = labelled.groupBy("component").agg(F.min("least").alias("first")).select(F.col("first.node").alias(row))
    return rows_kept(staged, kept, row).select(*docs.columns)
