"""SimHash near-dedup by meet-in-the-middle ball hashing.

A text (null: empty) is lower-cased in A-Z and cut into words at the six ASCII
white-space bytes; every run of three words, repeats included, is hashed by
XXH64 with seed 42 (fewer words: the whole sequence; none: fingerprint zero).
Bit i is set when more than half the hashes set it. Texts whose fingerprints
differ in at most three bits are linked, also at fingerprint zero.

Finding the links. A radius of three has no middle, so one block of bits is
masked first: the 64 bits form three blocks, and of at most three differing
bits one block holds one or more, unless there are none. With that block masked the distance is
two or less, and both sides meet where each has changed one bit: a fingerprint
emits, for each of the three masks, its masked value and all values at distance
one, 131 keys in all. Pairs that collide are verified on all 64 bits.
Equal fingerprints are collapsed first.

A key that gathers more fingerprints than ``bucket`` is not compared pair by
pair. Its members emit whole balls without a mask: radius one when their
number of set bits is even, radius two when it is odd. Within two bits the
balls of radius one meet, and at distance three the parities differ, so
one ball of each kind meets. Such a key holds at most 1 + 64 + 2016 fingerprints,
by construction. Both ways are exact.

Repeated rows are one class; a null ``doc_id`` is larger than any other; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import byte_values, extended, fresh, rows_kept, with_row, written
from curbline.llm.components import components

WORDS, SEED, RADIUS = 3, 42, 3
BUCKET = 4096
# The masked block of each of the three keys.
BLOCKS = ((0, 21), (21, 42), (42, 64))
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("crowded", pa.bool_())])


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """A 64-bit hash of every run of ``words`` words, repeats included; of the whole sequence if it is shorter."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    n = max(1, len(tokens) - words + 1)
    last = ends[-n:].tolist()
    first = [0, *(ends[:n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(first, last, strict=True)), np.uint64, n)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint as an unsigned int."""
    return majority(shingle_hashes(text, words))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half the hashes set."""
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def add_fingerprints(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a signed long ``name``: the fingerprint's 64 bits."""
    at = docs.columns.index("text")

    def add(batches):
        for given in batches:
            made = np.fromiter(map(fingerprint, byte_values(given.column(at))), np.uint64, given.num_rows)
            yield extended(pa.schema([*given.schema, (name, pa.int64())]), given, **{name: pa.array(made.view(np.int64))})

    return docs.mapInArrow(add, docs.withColumn(name, F.lit(0).cast("long")).schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def masked_variants(fp: Column) -> Column:
    """Array of the 131 keys. The masked block's bits are free, so they carry the block's number."""
    keys = []
    for number, (low, high) in enumerate(BLOCKS):
        mask = ((1 << high) - 1) ^ ((1 << low) - 1)
        base = fp.bitwiseAND(F.lit(_signed(~mask & (1 << 64) - 1))).bitwiseOR(
            F.lit(_signed((number + 1) << low)))
        flips = [0, *(_signed(1 << i) for i in range(64) if not low <= i < high)]
        keys += [base.bitwiseXOR(F.lit(flip)) for flip in flips]
    return F.array(*keys)


def ball_variants(fp: Column) -> Column:
    """The whole ball: radius one around fingerprints of even weight, radius two around the others."""
    bits = F.array(*(F.lit(_signed(1 << i)) for i in range(64))).cast("array<bigint>")
    one = F.concat(F.array(fp), F.transform(bits, lambda b: fp.bitwiseXOR(b)))
    pairs = F.flatten(F.transform(
        F.sequence(F.lit(0), F.lit(62)),
        lambda i: F.transform(F.sequence(i + 1, F.lit(63)),
                              lambda j: fp.bitwiseXOR(F.get(bits, i)).bitwiseXOR(F.get(bits, j)))))
    return F.when(F.bit_count(fp) % 2 == 0, one).otherwise(F.concat(one, pairs))


def _forest(members: np.ndarray, radius: int) -> tuple[list, list]:
    """Edges that connect whatever is linked among distinct fingerprints: fewer than there are members."""
    left = np.arange(len(members))
    a, b = [], []
    while len(left):
        wave = left[:1]
        left = left[1:]
        while len(wave) and len(left):
            reached = []
            for i in wave.tolist():
                near = np.bitwise_count(members[left] ^ members[i]) <= radius
                hit = left[near]
                left = left[~near]
                a += [members[i]] * len(hit)
                b += members[hit].tolist()
                reached.append(hit)
                if not len(left):
                    break
            wave = np.concatenate(reached)
    return a, b


def _collisions(bucket: int | None, radius: int):
    """Scans rows (key, fp) sorted by key: verified links of every key, or its members when it is crowded."""

    def emit(keys: np.ndarray, fps: np.ndarray):
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        two = first[size == 2]
        near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius
        a, b, crowded = [fps[two][near]], [fps[two + 1][near]], [np.zeros(near.sum(), bool)]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            members = fps[at:at + n]
            if bucket and n > bucket:
                x = y = members
            else:
                x, y = (np.array(v, np.uint64) for v in _forest(members, radius))
            a.append(x)
            b.append(y)
            crowded.append(np.full(len(x), bool(bucket and n > bucket)))
        columns = np.concatenate(a).astype(np.uint64), np.concatenate(b).astype(np.uint64), np.concatenate(crowded)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0].view(np.int64)), pa.array(columns[1].view(np.int64)), pa.array(columns[2])],
            schema=_FOUND)

    def members_of(fps: np.ndarray):
        """The members of a crowded key, without looking at its pairs."""
        fp = pa.array(fps.view(np.int64))
        return pa.RecordBatch.from_arrays([fp, fp, pa.array(np.ones(len(fps), bool))], schema=_FOUND)

    def run(batches):
        held: list = []  # the rows of the last key, which may go on in the next batch
        crowded_key = None
        for given in batches:
            keys = given.column(0).to_numpy(zero_copy_only=False)
            fps = given.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if crowded_key is not None:
                cut = int(np.searchsorted(keys, crowded_key, "right"))
                if cut:
                    yield members_of(fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or not held or held[-1][0][-1] != keys[-1]:
                done = [*held, (keys[:cut], fps[:cut])]
                held = []
                k, f = (np.concatenate(c) for c in zip(*done, strict=True))
                if len(k):
                    yield emit(k, f)
            held.append((keys[cut:], fps[cut:]))
            crowded_key = None
            if bucket and sum(len(h[0]) for h in held) > bucket:
                yield members_of(np.concatenate([h[1] for h in held]))
                held, crowded_key = [], keys[-1]
        if held:
            yield emit(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return run


def _meet(fps: DataFrame, variants, bucket: int | None, partitions: int) -> DataFrame:
    """(a, b, crowded) from the keys that ``variants`` gives to the distinct fingerprints ``fp``."""
    keyed = fps.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    dealt = keyed.repartition(partitions, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(_collisions(bucket, RADIUS), "a bigint, b bigint, crowded boolean").distinct()


def links(fps: DataFrame, bucket: int = BUCKET, keys_per_task: int = 4_000_000) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all those within three bits of each other."""
    per_fp = sum(1 + 64 - (high - low) for low, high in BLOCKS)
    n = fps.count()
    found = written(_meet(fps, masked_variants, bucket, max(1, -(-n * per_fp // keys_per_task))), "near")
    edges = found.where("not crowded").select("a", "b")
    crowded = written(found.where("crowded").select(F.col("a").alias("fp")).distinct(), "crowded")
    more = crowded.count()
    if more:
        edges = edges.unionByName(
            _meet(crowded, ball_variants, None, max(1, -(-more * 1073 // keys_per_task))).select("a", "b"))
    return edges


def classes(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, first_id, first_row, component_id, component_row): from rows (doc_id, row, fp), one per distinct
    fingerprint, with the smallest document of the fingerprint and of its component."""
    # The smallest id, then the smallest row; null ids come last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    distinct = written(prints.groupBy("fp").agg(F.min(order).alias("least")), "prints")
    joined = components(links(distinct.select("fp"), bucket), "a", "b").withColumnRenamed("node", "fp")
    labelled = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("least").alias("first"))
    # Written, so that the join with all documents has shuffles of its own, whose hot keys Spark can split.
    return written(labelled.join(least, "component").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("component_row")), "classes")


def near_groups(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, row, fp (signed long), component_id, kept."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = written(add_fingerprints(with_row(own, "row"), "fp").select("doc_id", "row", "fp"), "simhash")
    return prints.join(classes(prints, bucket), "fp").select(
        "doc_id", "row", "fp", "component_id", (F.col("row") == F.col("component_row")).alias("kept"))


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one document of each component; all columns stay as they are."""
    row, fp = fresh(docs, "row_key"), fresh(docs, "print_key")
    staged = written(add_fingerprints(with_row(docs, row), fp), "staged")
    prints = staged.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"),
                           F.col(fp).alias("fp"))
    kept = classes(prints, bucket).select(F.col("component_row").alias(row)).distinct()
    return rows_kept(staged, kept, row).select(*docs.columns)
