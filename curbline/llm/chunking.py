"""Substring dedup by content-defined chunking.

A gear hash (h = 2h + gear[byte], 16 bits, so it sees the last 16 bytes) rolls
over every text; a chunk ends where five of its bits are zero, between ``LEAST``
and ``MOST`` bytes after the last end and never inside a UTF-8 character. Ends depend
on nearby bytes only, so an insertion moves the chunks around it and no others.

Chunks are deduplicated by a 128-bit digest: the occurrence in the smallest
``doc_id`` (then text hash, then place) stays, later ones are cut out, also one
alone and a short text that is another's copy. ``run`` keeps runs of adjacent
duplicate chunks below so many bytes.

A null text is empty. Null ids come last in order. Rows that repeat id and text
count as the one document they repeat. An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import byte_values, written
from curbline.llm.spans import cut, keyed

LEAST, MOST, RUN = 16, 128, 1
GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=2).digest() for i in range(256)), "<u2")
_CHUNK = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("size", pa.int32()),
                    ("d1", pa.int64()), ("d2", pa.int64())])


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte, by doubling the window four times."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        wider = h.copy()
        wider[k:] += h[:-k] << k
        h = wider
    return h


def chunk_ends(text: bytes) -> list[int]:
    """The ends of the chunks of a text; the last one is its length."""
    data = np.frombuffer(text, np.uint8)
    n = len(text)
    if n <= LEAST:
        return [n] if n else []
    free = np.r_[(data[1:] & 0xC0) != 0x80, True]
    ends, begin = [], 0
    for end in (np.flatnonzero(((gear_hash(data) >> 11) & 31 == 0) & free) + 1).tolist():
        while end - begin > MOST:
            begin = _forced(text, begin)
            ends.append(begin)
        if end - begin >= LEAST:
            ends.append(end)
            begin = end
    while n - begin > MOST:
        begin = _forced(text, begin)
        ends.append(begin)
    if begin < n:
        ends.append(n)
    return ends


def _forced(text: bytes, begin: int) -> int:
    """An end ``MOST`` bytes on, or a little before where that lies inside a character."""
    end = begin + MOST
    while end > begin + MOST - 4 and text[end] & 0xC0 == 0x80:
        end -= 1
    return end


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, size, d1, d2) of every chunk."""
    def run(batches):
        digest = xxhash.xxh3_128_digest
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                given = whole.slice(at, 512)
                starts, ends, made, counts = [], [], [], []
                for text in byte_values(given.column(2)):
                    own = chunk_ends(text)
                    begins = [0, *own[:-1]] if own else []
                    starts += begins
                    ends += own
                    counts.append(len(own))
                    made += [digest(text[a:b]) for a, b in zip(begins, own, strict=True)]
                words = np.frombuffer(b"".join(made), "<i8").reshape(-1, 2)
                first, stop = np.array(starts, np.int32), np.array(ends, np.int32)
                times = np.repeat(np.arange(given.num_rows), counts)
                yield pa.RecordBatch.from_arrays(
                    [given.column(0).take(pa.array(times)), given.column(1).take(pa.array(times)), pa.array(first),
                     pa.array(stop - first), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())],
                    schema=_CHUNK)

    return keyed(docs).mapInArrow(run, "doc_id bigint, key bigint, start int, size int, d1 bigint, d2 bigint")


def duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, stop, first): the chunks whose digest occurs more than once; ``first`` marks the
    occurrence that stays."""
    table = written(chunks(docs), "chunks")
    # Half the digest first, with nothing else in the row: a partial count sends each key once per task.
    # Both aggregates are written, so that the joins have shuffles of their own, whose hot keys Spark can split.
    often = written(table.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1"), "often")
    some = written(table.join(often, "d1", "left_semi"), "candidates")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key"), F.col("start"))
    firsts = written(some.groupBy("d1", "d2").agg(
        F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firsts")
    return some.join(firsts, ["d1", "d2"]).select(
        "doc_id", "key", "start", (F.col("start") + F.col("size")).alias("stop"),
        (place == F.col("least")).alias("first"))


def dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """Every document without the chunks that stay elsewhere: doc_id, n_bytes, n_removed, n_spans,
    spans, kept, kept_sha256."""
    later = duplicates(docs).where("not first").select("doc_id", "key", "start", "stop")
    return cut(docs, later, run)
