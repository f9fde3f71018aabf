"""Exact dedup by a sharded cuckoo index of text digests.

Texts are equal when they are identical after lower-casing A-Z; a null text
counts as empty, empty texts are equal to one another. Of equal texts the row
with the largest ``doc_id`` stays (a null id is smaller than any other); rows
that repeat id and text are told apart by a row key, so exactly one stays.
Extra columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import byte_values, extended, fresh, rows_kept, with_row, written
from curbline.llm.cuckoo import CuckooIndex

DIGESTS = "doc_id bigint, row bigint, digest binary"
CHANGES = "kind int, digest binary, doc_id bigint, row bigint, n bigint"
GROUPS = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"
_CHANGE = pa.schema([("kind", pa.int32()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()),
                     ("n", pa.int64())])
_GROUP = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                    ("group_size", pa.int64())])

# Kinds of change to the index.
INSERT, DELETE = 1, 0


def text_digest(text: bytes) -> bytes:
    """SHA-256 of the text with A-Z lower-cased (``bytes.lower`` touches no other byte)."""
    return hashlib.sha256(text.lower()).digest()


def add_digests(docs: DataFrame, digest: str) -> DataFrame:
    """``docs`` with a binary column ``digest`` of its ``text``."""
    at = docs.columns.index("text")

    def add(batches):
        for given in batches:
            yield extended(pa.schema([*given.schema, (digest, pa.binary())]), given,
                           **{digest: [text_digest(t) for t in byte_values(given.column(at))]})

    return docs.mapInArrow(add, docs.withColumn(digest, F.lit(b"")).schema)


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest) of every row, as a written table."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(add_digests(with_row(own, "row"), "digest").select("doc_id", "row", "digest"), "digests")


def _merged(index: CuckooIndex, digest: bytes, doc_id, row: int, n: int) -> None:
    found = index.find(digest)
    if found is not None:
        rank = max((found[0] is not None, found[0] or 0, found[1]), (doc_id is not None, doc_id or 0, row))
        doc_id, row, n = rank[1] if rank[0] else None, rank[2], n + found[2]
    index.insert(digest, (doc_id, row, n))


def _apply(flush_at: int | None, kind: int | None):
    """Runs changes through one index per task. With ``flush_at`` the index is emptied whenever it
    holds so many keys: a map-side combine of bounded memory, merged again behind the shuffle."""

    def run(batches):
        index = CuckooIndex()
        drained = []

        def drain():
            rows = [(key, *value) for key, value in index.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            if kind is None:
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(columns, _GROUP, strict=True)], schema=_GROUP)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip([[kind] * len(rows), *columns], _CHANGE, strict=True)],
                schema=_CHANGE)

        for given in batches:
            for what, digest, doc_id, row, n in zip(*(c.to_pylist() for c in given.columns), strict=True):
                if what == DELETE:
                    index.delete(digest)
                    continue
                _merged(index, digest, doc_id, row, n)
                if flush_at and len(index) >= flush_at:
                    drained.append(drain())
                    index = CuckooIndex()
            yield from drained
            drained.clear()
        yield drain()

    return run


def _inserts(digests: DataFrame) -> DataFrame:
    return digests.select(F.lit(INSERT).alias("kind"), "digest", "doc_id", "row", F.lit(1).cast("long").alias("n"))


def _sharded(changes: DataFrame, keys_per_shard: int) -> DataFrame:
    """One index per shard of the digest space; a shard is sized by the counted changes."""
    shards = max(1, math.ceil(changes.count() / keys_per_shard))
    ordered = changes.repartition(shards, "digest").sortWithinPartitions("kind")
    return ordered.mapInArrow(_apply(None, None), GROUPS)


def build_index(digests: DataFrame, keys_per_shard: int = 100_000) -> DataFrame:
    """The index as a written table: a row per live digest with the row that stays and the group's size.

    Every task first runs its rows through a cuckoo index of its own, so a text
    that makes up a third of all rows reaches its shard as one row per task.
    """
    combined = written(_inserts(digests).mapInArrow(_apply(keys_per_shard, INSERT), CHANGES), "combined")
    return written(_sharded(combined, keys_per_shard), "index")


def retract(index: DataFrame, digests: DataFrame, gone: DataFrame, keys_per_shard: int = 100_000) -> DataFrame:
    """The index after the rows ``gone`` (a column ``row``) have left ``digests``.

    Their digests are loaded into the shards, deleted, and inserted again from
    the rows that remain, so a text lives on while one of its rows does.
    """
    rows = gone.select("row").distinct()
    touched = digests.join(rows, "row", "left_semi").select("digest").distinct()
    again = digests.join(touched, "digest", "left_semi").join(rows, "row", "left_anti")
    loads = index.join(touched, "digest", "left_anti").select(
        F.lit(INSERT).alias("kind"), "digest", F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"),
        F.col("group_size").alias("n"))
    old = index.join(touched, "digest", "left_semi").select(
        F.lit(-1).alias("kind"), "digest", F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"),
        F.col("group_size").alias("n"))
    null = F.lit(None).cast("long")
    deletes = touched.select(F.lit(DELETE).alias("kind"), "digest", null.alias("doc_id"), null.alias("row"),
                             null.alias("n"))
    combined = _inserts(again).mapInArrow(_apply(keys_per_shard, INSERT), CHANGES)
    changes = written(loads.unionByName(old).unionByName(deletes).unionByName(combined), "changes")
    return written(_sharded(changes, keys_per_shard), "index")


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, digest, keep_id, group_size, kept."""
    digests = tagged(docs)
    index = build_index(digests)
    return digests.join(index, "digest").select(
        "doc_id", "row", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies; all columns stay as they are."""
    row, digest = fresh(docs, "row_key"), fresh(docs, "text_digest")
    staged = written(add_digests(with_row(docs, row), digest), "staged")
    digests = staged.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"),
                            F.col(digest).alias("digest"))
    kept = build_index(digests).select(F.col("keep_row").alias(row))
    return rows_kept(staged, kept, row).select(*docs.columns)
