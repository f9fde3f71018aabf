"""Concatenate and cut: whole documents into token sequences of a fixed length.

All documents' tokens, each followed by a separator id, form one long line in
the order of the scan. A first pass writes the tokens with their place inside
their partition and sums them per partition; prefix sums over these totals give
every partition its global start; the second pass cuts at multiples of the
sequence length. Only the last sequence can need padding.

The ids of a text are those of ``tokenizers`` without added ones: a token that the file adds is
one id where its characters stand in a text.

A null or empty text is the separator alone; repeated rows are packed each;
null ids stay null; an empty table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import batch, written

SEQUENCE = 1024
# The fixed pattern by which byte-level tokenizer files split a text.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_TOKENS = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("continues", pa.bool_()), ("continued", pa.bool_())])

_encoders: dict[tuple[str, bool], tuple] = {}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """A byte-level BPE file's tokens as bytes with their ids, where the ids are also the order of its merges;
    None for any other tokenizer file."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    model, split = said["model"], said.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or said.get("normalizer") or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)):
        return None
    # Printable Latin-1 bytes are written as themselves, the others as the characters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    vocabulary = model["vocab"]
    if [vocabulary.get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    special = {t["content"] for t in said.get("added_tokens", ())}
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}


def added_of(path: str) -> dict[str, int] | None:
    """The file's added tokens with their ids; None where finding them in a text takes more than their characters."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or ()
    names = [t["content"] for t in tokens]
    if any(t.get(how) for t in tokens for how in ("single_word", "lstrip", "rstrip")) or any(
            a != b and a in b for a in names for b in names):
        return None
    return {t["content"]: t["id"] for t in tokens}


def encoder(path: str, added: bool = False):
    """(text -> ids as bytes, type of an id) for this worker process. With ``added``, the file's added tokens
    are recognised in a text, as ``encode(add_special_tokens=False)`` of the library does; without, special
    tokens are ordinary text.

    Byte-level files go through their ranks, which give the same ids at four times the speed.
    """
    if (path, added) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not added
        kind = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        ranks, special = ranks_of(path), added_of(path) if added else {}
        if ranks is None or special is None:
            _encoders[path, added] = lambda text: np.array(
                tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes(), kind
        else:
            coder = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
            _encoders[path, added] = lambda text: coder.encode_to_numpy(
                text, allowed_special="all", disallowed_special=()).astype(kind).tobytes(), kind
    return _encoders[path, added]


def tokenize(docs: DataFrame, path: str, separator: int = 0) -> DataFrame:
    """Written table of each document's ids (little-endian, two bytes each where the vocabulary allows)
    with its place in its partition."""

    def run(batches):
        encode, kind = encoder(path, added=True)
        end = np.array([separator], kind).tobytes()
        part, at, width = TaskContext.get().partitionId(), 0, np.dtype(kind).itemsize
        for given in batches:
            ids, starts, counts = [], [], []
            for text in given.column(1).to_pylist():
                own = encode(text or "") + end
                ids.append(own)
                starts.append(at)
                counts.append(len(own) // width)
                at += counts[-1]
            yield batch(_TOKENS, np.full(len(ids), part), given.column(0), starts, counts, ids)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(own.mapInArrow(run, "part bigint, doc_id bigint, local_start bigint, doc_tokens bigint, ids binary"),
                   "tokens")


def partition_starts(tokens: DataFrame) -> DataFrame:
    """(part, base): prefix sums over the partitions' token totals, in two levels so that no task sees
    more than a thousandth of the partitions."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total")).withColumn(
        "block", F.col("part").bitwiseAND(F.lit(~1023)))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("total")).select(
        "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("block_base"))
    return totals.join(blocks, "block").select(
        "part", (F.col("block_base") + F.coalesce(F.sum("total").over(inside), F.lit(0))).alias("base"))


def _cut(length: int, two_bytes: bool):
    kind = "<u2" if two_bytes else "<u4"

    def run(batches):
        for given in batches:
            rows: list[list] = [[] for _ in _PIECES]
            for doc_id, begin, total, ids in zip(*(c.to_pylist() for c in given.columns), strict=True):
                values = np.frombuffer(ids, kind).astype("<u4").tobytes()
                start = 0
                while start < total:
                    offset = (begin + start) % length
                    n = min(length - offset, total - start)
                    made = (doc_id, start, n, values[4 * start:4 * (start + n)], total, (begin + start) // length,
                            offset, start > 0, start + n < total)
                    for column, value in zip(rows, made, strict=True):
                        column.append(value)
                    start += n
            yield batch(_PIECES, *rows)

    return run


def pack(docs: DataFrame, path: str, length: int = SEQUENCE, separator: int = 0) -> DataFrame:
    """Pieces: doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id, offset,
    and the boundary flags ``continues`` (the document began earlier) and ``continued`` (it goes on)."""
    tokens = tokenize(docs, path, separator)
    # One row of 16 bytes per scan task, far below a hundred MB at any input: safe to broadcast.
    starts = F.broadcast(written(partition_starts(tokens), "starts"))
    _, kind = encoder(path, added=True)
    placed = tokens.join(starts, "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("begin"), "doc_tokens", "ids")
    return placed.mapInArrow(
        _cut(length, kind == "<u2"),
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, continues boolean, continued boolean")


def sequences(pieces: DataFrame, length: int = SEQUENCE, pad: int = 0) -> DataFrame:
    """Full sequences: sequence_id, ids (binary of exactly ``length`` ids), n_tokens, doc_ids in order.

    A sequence gathers at most ``length`` pieces, whatever the documents are.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    gathered = pieces.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("n_tokens"))
    padding = F.expr(f"unhex(repeat('{pad.to_bytes(4, 'little').hex()}', cast({length} - n_tokens as int)))")
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return gathered.select("sequence_id", F.concat(joined, padding).alias("ids"), "n_tokens",
                           F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
