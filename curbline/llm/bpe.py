"""Byte-level BPE by tree reduction.

A pre-token is cut into halves down to single bytes. Two neighbours are joined
by re-encoding a window at their border, first the last token of the left side
with the first one of the right side. The window grows to that side whose next
token does not stand: two adjacent tokens stand when encoding their bytes alone
gives the same two tokens, and a sequence is the encoding of its bytes exactly
when all its adjacent pairs stand. So a join is proved by the two pairs at the
window's edges, everything beyond them stays. Joining is associative, results of
short pieces are remembered, and a document's tokens are those of its
pre-tokens in order.

A pre-token that is itself in the vocabulary is that one token, as in the
library that defines the file format. Null texts are empty and give no tokens.
No special token is ever produced. Repeated rows are encoded each, null ids stay
null, an empty table gives an empty result, extra columns are not read.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.words import PartCache

#: Documents taken at a time, and ids decoded in one step.
ROWS, LEAF = 512, 4096
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DECODED = pa.schema([*_ENCODED, ("decoded", pa.binary())])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeBpe:
    """The encoder and decoder of one vocabulary; ``remember`` bounds what is kept of earlier pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 200_000):
        self.ranks, self.remember = ranks, remember
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.table = pa.array([self.tokens.get(i) for i in range(max(self.tokens, default=-1) + 1)], pa.large_binary())
        self.split = regex.compile(pattern).findall
        self.pieces: dict[bytes, tuple] = {}
        self.pairs: dict[tuple, tuple] = {}

    def merged(self, data: bytes) -> tuple:
        """Plain merging by rank, leftmost first: what a window is re-encoded with."""
        n, ranks = len(data), self.ranks
        if n == 1:
            return (ranks[data],)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[data[i:i + 2]], i, i + 2) for i in range(n - 1) if data[i:i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], end[j], after[i] = stop, 0, after[j]
            if after[j] < n:
                before[after[j]] = i
                pair = data[i:end[after[j]]]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, end[after[j]]))
            if before[i] >= 0:
                pair = data[before[i]:stop]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], before[i], stop))
        return tuple(ranks[data[i:end[i]]] for i in range(n) if end[i])

    def _pair(self, a: int, b: int) -> tuple:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= self.remember:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b])
        return found

    def stands(self, a: int, b: int) -> bool:
        return self._pair(a, b) == (a, b)

    def join(self, left: tuple, right: tuple) -> tuple:
        """The encoding of the two sides' bytes from the encodings of the sides."""
        if not left or not right:
            return left or right
        i, j, step = len(left) - 1, 1, 1
        window = self._pair(left[i], right[0])
        while True:
            left_stands = i == 0 or self.stands(left[i - 1], window[0])
            right_stands = j == len(right) or self.stands(window[-1], right[j])
            if left_stands and right_stands:
                return left[:i] + window + right[j:]
            if not left_stands:
                i = max(0, i - step)
            if not right_stands:
                j = min(len(right), j + step)
            step *= 2
            window = self.merged(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))

    def tree(self, piece: bytes) -> tuple:
        n = len(piece)
        if n == 1:
            return (self.ranks[piece],)
        found = self.pieces.get(piece) if n <= 32 else None
        if found is None:
            found = self.join(self.tree(piece[:n // 2]), self.tree(piece[n // 2:]))
            if n <= 32:
                if len(self.pieces) >= self.remember:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for match in self.split(text):
            piece = match.encode()
            whole = self.ranks.get(piece)
            if whole is None:
                ids += self.tree(piece)
            else:
                ids.append(whole)
        return ids

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        """The bytes of the ids: runs of at most ``LEAF`` are looked up in one step and joined up the tree."""
        if len(ids) > LEAF:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        taken = self.table.take(pa.array(ids, pa.int32()))
        if taken.null_count:
            raise ValueError("an id is not in the vocabulary")
        return b"".join(taken.to_pylist()) if taken.offset else _bytes(taken)


def _bytes(tokens: pa.LargeBinaryArray) -> bytes:
    """All values of an array that begins at its buffer's start, joined."""
    if not len(tokens):
        return b""
    _, offsets, data = tokens.buffers()
    end = int(np.frombuffer(offsets, np.int64, 1, 8 * len(tokens))[0])
    return data.slice(0, end).to_pybytes()


_coders: dict[tuple, TreeBpe] = {}
_caches: dict[tuple, PartCache] = {}


def coder(path: str, pattern: str) -> TreeBpe:
    """The coder of this worker process."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = TreeBpe(read_ranks(path), pattern)
    return _coders[path, pattern]


def _part_cache(path: str, pattern: str) -> PartCache:
    if (path, pattern) not in _caches:
        encode = coder(path, pattern).encode
        _caches[path, pattern] = PartCache(lambda parts: [np.array(encode(p), "<i4").tobytes() for p in parts])
    return _caches[path, pattern]


def _lists(parts: list[bytes]) -> pa.Array:
    """A list array over ids that are given as bytes."""
    offsets = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every whole text. ``pattern`` must keep white space and words apart in the way of
    the byte-level pattern, see ``words.parts``."""

    def run(batches):
        cache = _part_cache(path, pattern)
        for given in batches:
            for at in range(0, given.num_rows, ROWS):
                some = given.slice(at, ROWS)
                ids = []
                for text in some.column(1).to_pylist():
                    head, rest = cache.values(text or "")
                    ids.append(b"".join([head, *rest]))
                yield pa.RecordBatch.from_arrays([some.column(0), _lists(ids)], schema=_ENCODED)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids."""

    def run(batches):
        decoded = coder(path, pattern).decode
        for given in batches:
            for at in range(0, given.num_rows, ROWS):
                some = given.slice(at, ROWS)
                lists = some.column(1)
                ids = lists.values.to_numpy(zero_copy_only=False)
                ends = lists.offsets.to_numpy().tolist()
                made = [decoded(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1).cast(_ENCODED.field(1).type), pa.array(made, pa.binary())],
                    schema=_DECODED)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")
