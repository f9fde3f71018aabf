"""Exact removal of repeated byte strings by sparse, enhanced suffix arrays.

A string of ``LENGTH`` bytes is repeated when it starts at two places of the
corpus, never across documents; every byte under a repeated string is removed.
Repeat groups are found from ``LEAST`` bytes on, and what is removed is derived from
the groups of ``LENGTH`` bytes or more.

Which suffixes. Every window of ``LEAST`` bytes chooses an anchor: the place
of the smallest hash among its ``GRAM``-byte grams, the first of equals. The choice
depends on the window alone, so equal windows choose the same place, and
windows with one anchor lie side by side. Only suffixes at anchors are kept, about
one in 89 bytes, each with its context: the bytes under its windows and
half of ``LENGTH - LEAST`` on both sides. A string of ``LEAST`` to ``LENGTH`` bytes lies
wholly in the context of the anchor that its middle window chooses, wherever it occurs.

Anchors whose gram occurs once are out. Equal contexts are collapsed with a
count; a context that occurs twice or more is a repeat group as a whole. What is left
are grams with two or more different contexts. Spark sorts these by the bytes
from the anchor on, which is the suffix array of the group; a task computes
the common prefixes of neighbours and scans them with a stack for the tree of
common-prefix intervals, from the leaves up. An interval of prefix p holds its members in the
order of the bytes before the anchor; the smaller children are merged into the largest, and
only where that puts a new member beside another can a longer extension e to the left appear.
All members that share the extension are one repeat group of p + e bytes, listed where one of
them has no group that reaches as far on both sides, and once with all members that share
``LEAST`` bytes or more, the widest one. It is right-maximal, as it joins children of
the interval, and left-maximal, as e ends where its members differ or a context ends. A repeat longer than a context is seen in pieces, one for each anchor.

Equal contexts are joined back last, so that a group lists all its occurrences. A
gram with more than ``CROWD`` different contexts is not given to one task: its
windows of both lengths are hashed and counted by Spark, and the places of a digest are the group.

A null text is empty; texts shorter than ``LEAST`` have no repeat. A row that
repeats another's text is another document, so both lose it. An empty table gives
an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import byte_values, written
from curbline.llm.spans import cut, keyed, merged, same_document

LENGTH, LEAST, GRAM, CROWD = 400, 240, 64, 20_000
#: Bytes handled at a time; places must fit the 24 bits they take in a key.
SEGMENT = 1 << 23
_TABLE = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8, person=b"gram").digest()
                                for i in range(256)), "<u8")
_ODD = 0x9E3779B97F4A7C15
_ANCHOR = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int32()), ("low", pa.int32()),
                     ("high", pa.int32()), ("gram", pa.int64()), ("context", pa.int64())])
_ANCHOR_DDL = "doc_id bigint, key bigint, at int, low int, high int, gram bigint, context bigint"
_CONTEXT = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("crowd", pa.int64()), ("n", pa.int64()),
                      ("ahead", pa.binary()), ("behind", pa.binary())])
_CONTEXT_DDL = "gram bigint, context bigint, crowd bigint, n bigint, ahead binary, behind binary"
_AROUND = pa.list_(pa.struct([("back", pa.int32()), ("on", pa.int32())]))
_FOUND = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("long", _AROUND), ("every", _AROUND)])
_FOUND_DDL = ("gram bigint, context bigint, long array<struct<back:int,on:int>>, "
              "every array<struct<back:int,on:int>>")
_GROUP = pa.schema([("gram", pa.int64()), ("number", pa.int64()), ("context", pa.int64()), ("back", pa.int32()),
                    ("on", pa.int32())])
_GROUP_DDL = "gram bigint, number bigint, context bigint, back int, on int"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit polynomial hash of the ``gram`` bytes (a power of two) from every place on, mixed."""
    h, power, k = _TABLE[data], _ODD, 1
    while k < gram:
        h = h[:-k] * np.uint64(power) + h[k:]
        power = power * power % (1 << 64)
        k *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from every place on."""
    k = 1
    while 2 * k <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    rest = width - k
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(text: bytes, length: int = LEAST, gram: int = GRAM) -> list[tuple[int, int, int, int]]:
    """(place, first window, last window, gram hash) of every anchor; windows are named by their start."""
    made = []
    for base in range(0, max(0, len(text) - length + 1), SEGMENT):
        data = np.frombuffer(text, np.uint8, min(SEGMENT + length - 1, len(text) - base), base)
        hashes = gram_hashes(data, gram)
        ranked = (hashes & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (_lowest(ranked, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:] - 1, len(chosen) - 1]
        place = chosen[first]
        made += zip((place + base).tolist(), (first + base).tolist(), (last + base).tolist(),
                    hashes[place].view(np.int64).tolist(), strict=True)
    return made


def anchor_table(docs: DataFrame, length: int, least: int, gram: int) -> DataFrame:
    """Every anchor of every document with its context ``low`` to ``high`` and the digest of that."""
    half = (length - least + 1) // 2

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                given = whole.slice(at, 512)
                rows, counts, contexts = [], [], []
                for text in byte_values(given.column(2)):
                    own = [(place, max(0, first - half), min(len(text), last + least + half), hashed)
                           for place, first, last, hashed in anchors(text, least, gram)]
                    rows += own
                    counts.append(len(own))
                    contexts += [digest(text[low:high], place - low) for place, low, high, _ in own]
                times = pa.array(np.repeat(np.arange(given.num_rows), counts))
                columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [given.column(0).take(times), given.column(1).take(times),
                     *(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.int64()),
                     pa.array(np.array(contexts, np.uint64).view(np.int64))], schema=_ANCHOR)

    return keyed(docs).mapInArrow(run, _ANCHOR_DDL)


def _context_bytes(batches):
    """From (text, wanted): the bytes ahead of each wanted anchor, and those behind it in reverse."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            given = whole.slice(at, 256)
            rows: list[list] = [[] for _ in _CONTEXT]
            for text, wanted in zip(byte_values(given.column(0)), given.column(1).to_pylist(), strict=True):
                for w in wanted:
                    made = (w["gram"], w["context"], w["crowd"], w["n"],
                            text[w["at"]:w["high"]], text[w["low"]:w["at"]][::-1])
                    for column, value in zip(rows, made, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(rows, _CONTEXT, strict=True)], schema=_CONTEXT)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


def prefix_intervals(prefixes: list[int], least: int):
    """(p, first, last) of every common-prefix interval with p >= ``least``, by one scan with a stack.

    ``prefixes[i]`` is the common prefix of suffixes i and i + 1; an interval holds suffixes first to last.
    """
    stack: list[list[int]] = []
    for i, p in enumerate([*prefixes, 0]):
        first = i
        while stack and stack[-1][0] > p:
            height, first = stack.pop()
            yield height, first, i
        if p >= least and (not stack or stack[-1][0] < p):
            stack.append([p, first])


def repeat_groups_of(ahead: list[bytes], behind: list[bytes], least: int, widest: bool = True):
    """(p, e, members) of the repeat groups of ``least`` bytes or more; ``ahead`` is sorted, members are its indexes.

    Intervals come from the leaves up. Their members are kept as ranks by the bytes behind. The ``widest``
    groups add nothing to what the others cover.
    """
    rank = sorted(range(len(ahead)), key=behind.__getitem__)
    place = [0] * len(rank)
    for i, member in enumerate(rank):
        place[member] = i
    prefixes = [common(a, b) for a, b in zip(ahead, ahead[1:], strict=False)]
    open_sets: list[tuple[int, int, list[int]]] = []
    for p, first, last in prefix_intervals(prefixes, 1):
        children, loose, at = [], [], last
        while open_sets and open_sets[-1][0] >= first:
            child = open_sets.pop()
            loose += range(child[1] + 1, at + 1)
            at = child[0] - 1
            children.append(child[2])
        loose += range(first, at + 1)
        children.sort(key=len)
        order = children.pop() if children else []
        #: Child that a new member comes from; members of the largest one are not listed.
        added = {r: n for n, child in enumerate(children + [[place[i]] for i in loose]) for r in child}
        if len(added) * 8 > len(order):
            order = sorted([*order, *added])
        else:
            for r in added:
                insort(order, r)
        open_sets.append((first, last, order))
        found = dict(_left_groups(p, order, added, rank, behind, least))
        if widest:
            found |= _widest(p, order, added, rank, behind, least)
        for (e, start), stop in found.items():
            yield p, e, [rank[r] for r in order[start:stop]]


def _widest(p: int, order: list[int], added: dict[int, int], rank: list[int], behind: list[bytes], least: int) -> dict:
    """Groups of one interval with all members that share ``least`` bytes: {(e, start): stop} within ``order``."""
    found = {}
    start, e = 0, len(behind[rank[order[0]]])
    for i in range(1, len(order) + 1):
        same = common(behind[rank[order[i - 1]]], behind[rank[order[i]]]) if i < len(order) else -1
        if same >= max(0, least - p):
            e = min(e, same)
            continue
        if i - start > 1 and len({added.get(r) for r in order[start:i]}) > 1:
            found[e, start] = i
        if i < len(order):
            start, e = i, len(behind[rank[order[i]]])
    return found


def _left_groups(p: int, order: list[int], added: dict[int, int], rank: list[int], behind: list[bytes], least: int):
    """The groups of one interval that join members of different children and reach further for one of theirs."""
    def shared(i: int) -> int:
        """Common extension of the members at i and i + 1; -1 at the ends."""
        return common(behind[rank[order[i]]], behind[rank[order[i + 1]]]) if 0 <= i < len(order) - 1 else -1

    new = {bisect_left(order, r) for r in added}
    ended: dict[int, int] = {}
    for i in sorted({j for n in new for j in (n - 1, n, n + 1) if 0 <= j < len(order)}):
        e = max(shared(i - 1), shared(i))
        if p + e < least or i <= ended.get(e, -1):
            continue
        first = last = i
        while shared(first - 1) >= e:
            first -= 1
        while shared(last) >= e:
            last += 1
        ended[e] = last
        if len({added.get(r) for r in order[first:last + 1]}) > 1:
            yield (e, first), last + 1


def _found_of(rows: list[tuple], length: int, least: int) -> list[tuple]:
    """What the groups of one gram cover in each of its contexts, by groups of ``length`` and of ``least`` bytes."""
    long: dict[int, set] = {}
    every: dict[int, set] = {}
    for p, e, members in repeat_groups_of([r[4] for r in rows], [r[5] for r in rows], least, widest=False):
        for m in members:
            every.setdefault(m, set()).add((-e, p))
            if p + e >= length:
                long.setdefault(m, set()).add((-e, p))
    return [(rows[m][0], rows[m][1], *([{"back": -a, "on": b} for a, b in merged(list(s))]
                                       for s in (long.get(m, ()), spans)))
            for m, spans in every.items() if rows[m][3] == 1]


def _groups_of(rows: list[tuple], length: int, least: int) -> list[tuple]:
    """(gram, number, context, back, on): the groups of one gram, one row for each context in them."""
    found = repeat_groups_of([r[4] for r in rows], [r[5] for r in rows], least)
    return [(rows[m][0], number, rows[m][1], e, p) for number, (p, e, members) in enumerate(found) for m in members]


def _scan(per_gram, schema: pa.Schema, length: int, least: int):
    """Runs ``per_gram`` over the contexts of every gram, which arrive sorted by gram and the bytes ahead."""
    def run(batches):
        def made(rows):
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        held: list[tuple] = []
        for given in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in given.columns), strict=True):
                if held and held[-1][:2] == row[:2]:  # read from a repeated row of the table
                    continue
                if held and held[0][0] != row[0]:
                    out += per_gram(held, length, least)
                    held = []
                held.append(row)
            yield made(out)
        yield made(per_gram(held, length, least) if held else [])

    return run


def _windows(size: int):
    """Every window of a crowded gram's contexts: (gram, context, back, on, d1, d2)."""
    schema = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("back", pa.int32()), ("on", pa.int32()),
                        ("d1", pa.int64()), ("d2", pa.int64())])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                grams, contexts, backs, digests = [], [], [], []
                for gram, context, _, _, ahead, behind in zip(
                        *(c.to_pylist() for c in whole.slice(at, 128).columns), strict=True):
                    text = behind[::-1] + ahead
                    n = max(0, len(text) - size + 1)
                    grams += [gram] * n
                    contexts += [context] * n
                    backs += range(len(behind), len(behind) - n, -1)
                    digests += [xxhash.xxh3_128_digest(text[i:i + size]) for i in range(n)]
                words = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams, pa.int64()), pa.array(contexts, pa.int64()), pa.array(backs, pa.int32()),
                     pa.array(size - np.array(backs, np.int32)), pa.array(words[:, 0].copy()),
                     pa.array(words[:, 1].copy())], schema=schema)

    return run


def _crowded(contexts: DataFrame, crowd: int, size: int) -> DataFrame:
    """(gram, context, back, on, d1, d2): windows of crowded grams that occur twice, told by their digest and
    place around the anchor: neighbouring contexts overlap, and a place is not its own repeat."""
    windows = contexts.where(F.col("crowd") > crowd).mapInArrow(
        _windows(size), "gram bigint, context bigint, back int, on int, d1 bigint, d2 bigint")
    key = ["gram", "back", "d1", "d2"]
    twice = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    return windows.join(twice, key, "left_semi")


def candidates(docs: DataFrame, length: int, least: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(anchors whose gram occurs more than once, their distinct contexts, the bytes of contexts of
    grams with two or more of them)."""
    table = written(anchor_table(docs, length, least, gram), "anchors")
    # Written, so that the join has shuffles of its own, whose hot keys Spark can split.
    often = written(table.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "often")
    repeated = written(table.join(often, "gram", "left_semi"), "repeated")
    place = F.struct("doc_id", "key", "at", "low", "high")
    contexts = written(repeated.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("p")), "contexts")
    several = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    wanted = contexts.join(several, "gram").groupBy(
        F.col("p.doc_id").alias("doc_id"), F.col("p.key").alias("key")).agg(F.collect_list(F.struct(
            "gram", "context", "crowd", "n", "p.at", "p.low", "p.high")).alias("wanted"))
    texts = keyed(docs)
    joined = texts.join(wanted, same_document(texts, wanted)).select("text", "wanted")
    return repeated, contexts, written(joined.mapInArrow(_context_bytes, _CONTEXT_DDL), "context-bytes")


def _sorted(contexts: DataFrame, crowd: int) -> DataFrame:
    """The suffix arrays: a gram's contexts in one task, sorted by the bytes from the anchor on."""
    return contexts.where(F.col("crowd") <= crowd).repartition("gram").sortWithinPartitions(
        "gram", "ahead", "context")


def _whole(contexts: DataFrame) -> DataFrame:
    """Contexts that occur more than once, as (gram, context, back, on)."""
    return contexts.where("n > 1").select(
        "gram", "context", F.expr("p.at - p.low").alias("back"), F.expr("p.high - p.at").alias("on"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, least: int = LEAST, gram: int = GRAM,
                   crowd: int = CROWD) -> DataFrame:
    """(doc_id, key, start, stop, gone): spans under repeat groups; ``gone`` where the group has ``length`` bytes.

    The groups of a context are merged before its occurrences are joined, so a context with very many
    occurrences or groups gives a few rows for each occurrence.
    """
    repeated, contexts, texts = candidates(docs, length, least, gram)
    scanned = _sorted(texts, crowd).mapInArrow(_scan(_found_of, _FOUND, length, least), _FOUND_DDL)
    around = F.expr("array(struct(back, on))")
    none = F.expr("cast(array() as array<struct<back:int,on:int>>)")
    found = scanned.unionByName(_whole(contexts).select(
        "gram", "context", F.when(F.expr(f"back + on >= {length}"), around).otherwise(none).alias("long"),
        around.alias("every")))
    for size, long, every in ((length, around, none), (least, none, around)):
        found = found.unionByName(_crowded(texts, crowd, size).select(
            "gram", "context", long.alias("long"), every.alias("every")))
    each = F.explode(F.expr("concat(transform(long, s -> struct(s.back, s.on, true as gone)), "
                            "transform(every, s -> struct(s.back, s.on, false as gone)))"))
    return repeated.join(written(found, "found"), ["gram", "context"]).select(
        "doc_id", "key", "at", each.alias("s")).select(
        "doc_id", "key", F.expr("at - s.back").alias("start"), F.expr("at + s.on").alias("stop"), "s.gone")


def maximal_repeats(docs: DataFrame, length: int = LENGTH, least: int = LEAST, gram: int = GRAM,
                    crowd: int = CROWD) -> DataFrame:
    """(group, length, doc_id, key, start): repeat groups of ``least`` bytes or more, one row per occurrence.

    A group belongs to an anchor's gram, so a string with several anchors has a group for each. Its name is
    a string: the gram and a number, a context or a digest within it.
    """
    repeated, contexts, texts = candidates(docs, length, least, gram)
    columns = ["gram", "context", "back", "on"]
    rows = [
        _sorted(texts, crowd).mapInArrow(_scan(_groups_of, _GROUP, length, least), _GROUP_DDL).select(
            F.concat_ws(":", "gram", "number").alias("group"), *columns),
        _whole(contexts).select(F.concat_ws(":", "gram", F.lit("whole"), "context").alias("group"), *columns),
        _crowded(texts, crowd, least).select(F.concat_ws(":", "gram", "back", "d1", "d2").alias("group"), *columns),
    ]
    found = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return repeated.join(found, ["gram", "context"]).select(
        "group", F.expr("back + on").alias("length"), "doc_id", "key", F.expr("at - back").alias("start"))


def remove(docs: DataFrame, length: int = LENGTH, least: int = LEAST, gram: int = GRAM,
           crowd: int = CROWD) -> DataFrame:
    """Every document without its repeated strings: doc_id, n_bytes, n_removed, n_spans, spans, kept,
    kept_sha256, n_noted and noted: the bytes and spans under repeat groups of ``least`` bytes or more."""
    return cut(docs, repeated_spans(docs, length, least, gram, crowd))
