"""Byte spans of documents: merged, cut out of the texts, and joined back without a row key.

A document is told by its ``doc_id`` and a 64-bit hash of its text, which any scan
gives again, so no copy of the texts has to be written to number them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import byte_values

_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                  ("kept", pa.binary()), ("kept_sha256", pa.string()), ("n_noted", pa.int64()),
                  ("noted", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
_CUT_DDL = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
            "spans array<struct<start:int,stop:int>>, kept binary, kept_sha256 string, "
            "n_noted bigint, noted array<struct<start:int,stop:int>>")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, text); a null text is empty."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.select("doc_id", F.xxhash64("text").alias("key"), "text")


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])


def merged(spans: list[tuple[int, int]], least: int = 1) -> list[tuple[int, int]]:
    """Sorted disjoint spans; touching ones are joined, results shorter than ``least`` are left out."""
    made: list[list[int]] = []
    for start, stop in sorted(spans):
        if made and start <= made[-1][1]:
            made[-1][1] = max(made[-1][1], stop)
        else:
            made.append([start, stop])
    return [(a, b) for a, b in made if b - a >= least]


def cut(docs: DataFrame, spans: DataFrame, least: int = 1) -> DataFrame:
    """Every document without its ``spans`` (doc_id, key, start, stop); the list of a document is bounded
    by its text. Spans whose column ``gone`` is false are noted only; without that column all are cut.
    Returns doc_id, n_bytes, n_removed, n_spans, spans, kept (bytes), kept_sha256, n_noted, noted."""
    gone = F.col("gone") if "gone" in spans.columns else F.lit(True).alias("gone")
    lists = spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop", gone)).alias("found"))
    texts = keyed(docs)
    joined = texts.join(lists, same_document(texts, lists), "left").select(texts["doc_id"], texts["text"], "found")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                given = whole.slice(at, 512)
                rows: list[list] = [[] for _ in _CUT]
                for doc_id, text, found in zip(given.column(0).to_pylist(), byte_values(given.column(1)),
                                               given.column(2).to_pylist(), strict=True):
                    gone = merged([(s["start"], s["stop"]) for s in found or () if s["gone"]], least)
                    noted = merged([(s["start"], s["stop"]) for s in found or ()], least)
                    edges = [0, *(e for span in gone for e in span), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    made = (doc_id, len(text), len(text) - len(kept), len(gone),
                            [{"start": a, "stop": b} for a, b in gone], kept, hashlib.sha256(kept).hexdigest(),
                            sum(b - a for a, b in noted), [{"start": a, "stop": b} for a, b in noted])
                    for column, value in zip(rows, made, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(rows, _CUT, strict=True)], schema=_CUT)

    return joined.mapInArrow(run, _CUT_DDL)
