"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Vectors are compared only when their labels are equal and not null, by cosine in
double precision; a pair at ``least`` or more is linked. Vectors that are null,
zero, or hold null or non-finite components link with nothing, and neither do
vectors of different lengths.

Identical vectors of a label are collapsed into one with a count of copies, kept as
floats where all their components are. Centroids are fitted on at most ``fit_rows``
of these (the only sample; every vector is assigned and compared). A vector lives in
the cell of its nearest centroid. Labels of at most ``per_cell`` vectors
(less of long ones) share groups and are compared there without cells; every other
label is a group of its own.

A group's cells are packed into blocks of at most ``block`` vectors and ``_ROOM``
components, larger cells into several. Blocks of a group meet in a product that
reads them again instead of shuffling a copy of a vector for each meeting, so disk
grows with the vectors alone and no task with a cell. It returns link counts and a
spanning forest of what it found, never the pairs.

Two bounds save work, both exact, so no pair is lost. A pair in reach differs by at
most its chord sqrt(2 - 2 least), and so does its projection on any direction; cells
a and b are compared along a - b, with both sides sorted by it. What remains goes
through a product of floats on the ``width`` strongest directions, to which the
lengths of the rests are added, and only pairs that reach ``least`` with that are
multiplied in full.

Repeated rows count as copies; null ids are larger than any other as
representative; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import batch, with_row, written
from curbline.llm.components import components
from curbline.session import settings

#: Rows of a batch that Python gets, and components of a block: both bound what a task holds.
_ROWS, _ROOM = 1024, 1 << 20
#: Pairs of a product that are looked at together.
_TILE, _SPAN = 256, 1024
#: Links that are held before they are reduced to a forest.
_EDGES = 1 << 20
#: Bytes of blocks that a task of the product holds of either side, and of the groups that meet in one product.
_SIDE, _BUNDLE = 64 << 20, 256 << 20
#: Centroids that are closer give no direction, as rounding would move it.
_APART = 1e-4
_SLACK = 1e-9
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_READ = pa.schema([("vec_id", pa.int64()), ("row", pa.int64()), ("label", pa.string()), ("dim", pa.int32()),
                   ("raw", pa.binary()), ("digest", pa.binary())])
_COUNTED = pa.schema([("group", pa.int32()), ("cell", pa.int32()), ("n", pa.int64())])
_DEALT = pa.schema([("group", pa.int32()), ("block", pa.int32()), ("dim", pa.int32()), ("cell", pa.int32()),
                    ("label", pa.string()), ("node", pa.int64()), ("copies", pa.int64()), ("raw", pa.binary())])
_PACKED = pa.schema([("group", pa.int32()), ("block", pa.int32()), ("dim", pa.int32()), ("cells", pa.binary()),
                     ("labels", pa.binary()), ("nodes", pa.binary()), ("copies", pa.binary()), ("raw", pa.binary()),
                     ("home", pa.list_(pa.int32())), ("reach", pa.list_(pa.int32()))])
_LINKED = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
_BLOCK = ("block", "dim", "cells", "labels", "nodes", "copies", "raw")


def _sql(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary",
             pa.list_(pa.int32()): "array<int>"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def usable(embedding) -> bool:
    """False for vectors that can't be compared; ``embedding`` is a list or None."""
    if not embedding or any(v is None for v in embedding):
        return False
    v = np.asarray(embedding, float)
    return bool(np.isfinite(v).all() and (v != 0).any())


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first keeps squares in range."""
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def _read(given: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of vec_id, row, label and embedding: usable vectors as bytes, with a digest where they have a label."""
    lists, labels = given.column(3), given.column(2).to_pylist()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    values = lists.flatten().to_numpy(zero_copy_only=False) + 0.0  # a null is NaN; -0.0 becomes 0.0
    with np.errstate(over="ignore"):
        floats, values = values.astype("<f4"), values.astype("<f8")
    starts = np.cumsum(sizes) - sizes
    filled = np.flatnonzero(sizes)
    at = starts[filled]

    def every(flags):
        found = np.zeros(len(sizes), bool)
        found[filled] = np.logical_and.reduceat(flags, at) if len(filled) else False
        return found

    fit = every(np.isfinite(values)) & ~every(values == 0)
    narrow = every(floats == values)
    as_floats, as_doubles = floats.tobytes(), values.tobytes()
    raws: list = [None] * len(sizes)
    digests: list = [None] * len(sizes)
    for i in np.flatnonzero(fit).tolist():
        a, b = int(starts[i]), int(starts[i] + sizes[i])
        raws[i] = as_floats[4 * a:4 * b] if narrow[i] else as_doubles[8 * a:8 * b]
        if labels[i] is not None:
            digests[i] = hashlib.sha256(b"%d,%d," % (b - a, len(raws[i])) + raws[i] + labels[i].encode()).digest()
    return batch(_READ, given.column(0), given.column(1), given.column(2), sizes, raws, digests)


def _unit_floats(v: np.ndarray) -> np.ndarray:
    """As ``unit``, of floats: their squares are in the range of doubles."""
    v = v.astype(float)
    v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return v


def _units(raws: list[bytes], dim: int) -> np.ndarray:
    """Unit rows of vectors of ``dim`` components, floats or doubles."""
    if all(len(raw) == 4 * dim for raw in raws):
        return _unit_floats(np.frombuffer(b"".join(raws), "<f4").reshape(-1, dim))
    rows = np.empty((len(raws), dim))
    for wide, kind in ((4, "<f4"), (8, "<f8")):
        own = [i for i, raw in enumerate(raws) if len(raw) == wide * dim]
        if own:
            rows[own] = np.frombuffer(b"".join(raws[i] for i in own), kind).reshape(-1, dim)
    return unit(rows)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centroids by cosine; an empty cell is moved to the row that fits worst."""
    pick = np.random.default_rng(seed)
    centroids = rows[pick.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        near = rows @ centroids.T
        cell, fit = near.argmax(1), near.max(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, rows)
        for empty in np.flatnonzero(np.bincount(cell, minlength=k) == 0):
            worst = int(fit.argmin())
            sums[empty], fit[worst] = rows[worst], 2.0
        norm = np.sqrt((sums * sums).sum(1, keepdims=True))
        centroids = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centroids)
    return centroids


def strongest(rows: np.ndarray, least: float) -> np.ndarray:
    """Orthonormal columns of which a product is cheapest, counting the pairs that it leaves to be multiplied in full."""
    dim = rows.shape[1]
    basis = np.linalg.eigh(rows.T @ rows)[1][:, ::-1]
    some = rows[:1024] @ basis
    costs = {}
    for width in sorted({*(w for w in (8, 16, 24, 32, 48, 64, 96, 128, 192, 256) if w < dim), dim}):
        lead = some[:, :width]
        rest = np.sqrt(np.maximum(1 - (lead * lead).sum(1), 0))
        left = (lead @ lead.T + rest[:, None] * rest >= least).mean() - 1 / len(some)
        costs[width] = 12 + width + 300_000 * max(left, 0)
    return np.ascontiguousarray(basis[:, :min(costs, key=costs.get)])


class Layout(NamedTuple):
    """Where vectors go. Known to every task; it has a number for each label, cell and block of over ``per_cell`` vectors."""

    groups: dict[tuple[str, int], int]         # of a label and length
    shared: dict[int, tuple[int, int]]         # by length: the first group of small labels and how many there are
    centroids: np.ndarray
    basis: np.ndarray
    blocks: dict[tuple[int, int], tuple[int, int]] = {}  # by group and cell: the first block and how many there are


def fit_layout(distinct: DataFrame, least: float, per_cell: int, fit_rows: int, max_cells: int) -> Layout:
    """Groups, and centroids for the most frequent vector length from a sample of at most ``fit_rows`` vectors."""
    sizes = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    alone = F.col("n") > F.least(F.lit(per_cell), F.lit(_ROOM) / F.col("dim"))
    large = sizes.where(alone).orderBy(F.desc("n"), "label", "dim").collect()
    lengths = sizes.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.when(~alone, F.col("n"))).alias("small")).orderBy(F.desc("n"), "dim").collect()
    groups = {(r["label"], r["dim"]): i for i, r in enumerate(large)}
    shared, taken = {}, len(groups)
    for r in lengths:
        shared[r["dim"]] = taken, max(1, math.ceil((r["small"] or 0) / min(per_cell, max(1, _ROOM // r["dim"]))))
        taken += shared[r["dim"]][1]
    if not lengths:
        return Layout(groups, shared, np.ones((1, 1)), np.ones((1, 1)))
    common = lengths[0]["dim"]
    counts = [r["n"] for r in large if r["dim"] == common] or [1]
    sample = distinct.where(F.col("dim") == common).orderBy(F.xxhash64("node")).limit(fit_rows)
    rows = _units([bytes(r["raw"]) for r in sample.select("raw").collect()], common)
    k = min(max_cells, math.ceil(sum(counts) / len(counts) / per_cell), len(rows))
    return Layout(groups, shared, spherical_kmeans(rows, k), strongest(rows, least))


def _placed(layout: Layout, given: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Group and cell of every row; -1 is the cell of vectors that are compared without cells."""
    labels, raws = given.column("label").to_pylist(), given.column("raw").to_pylist()
    dims = given.column("dim").to_pylist()
    group, cell = np.empty(len(raws), np.int32), np.full(len(raws), -1, np.int32)
    for i, (label, dim) in enumerate(zip(labels, dims, strict=True)):
        found = layout.groups.get((label, dim))
        if found is None:
            first, many = layout.shared[dim]
            found = first + zlib.crc32(label.encode()) % many
        elif dim == layout.centroids.shape[1]:
            cell[i] = 0
        group[i] = found
    own = np.flatnonzero(cell == 0)
    if len(own):
        rows = _units([raws[i] for i in own], layout.centroids.shape[1])
        cell[own] = (rows @ layout.centroids.T).argmax(1)
    return group, cell


def _counted(layout: Layout):
    def run(batches):
        for given in batches:
            if not given.num_rows:
                continue
            found, n = np.unique(np.stack(_placed(layout, given)), axis=1, return_counts=True)
            yield batch(_COUNTED, found[0], found[1], n)

    return run


def with_blocks(layout: Layout, distinct: DataFrame, block: int) -> Layout:
    """Neighbouring cells of a group share a block while there is room; a larger cell gets several."""
    counts = distinct.mapInArrow(_counted(layout), _sql(_COUNTED)).groupBy("group", "cell").agg(
        F.sum("n").alias("n")).orderBy("group", "cell").collect()
    dims = {group: dim for (_, dim), group in layout.groups.items()}
    blocks, made, before, held = {}, 0, None, 0
    for r in counts:
        group, cell, n = r["group"], r["cell"], r["n"]
        room = max(1, min(block, _ROOM // dims[group])) if group in dims else math.inf
        if group != before or held + n > room:
            made, held = made + 1, 0
        many = max(1, math.ceil(n / room))
        blocks[group, cell] = made, many
        held = held + n if many == 1 else math.inf
        made, before = made + many - 1, group
    return layout._replace(blocks=blocks)


def _dealt(layout: Layout):
    last = {group: found for (group, _), found in layout.blocks.items()}

    def run(batches):
        for given in batches:
            group, cell = _placed(layout, given)
            nodes = given.column("node").to_pylist()
            # A cell that was not met when they were counted can only come of rounding; any block of the group does.
            found = [layout.blocks.get((g, c), last.get(g)) for g, c in zip(group.tolist(), cell.tolist(), strict=True)]
            blocks = [first + hash((n, 1)) % many for n, (first, many) in zip(nodes, found, strict=True)]
            labels = [None if g < len(layout.groups) else label
                      for g, label in zip(group.tolist(), given.column("label").to_pylist(), strict=True)]
            yield batch(_DEALT, group, np.array(blocks, np.int32), given.column("dim"), cell, labels,
                        given.column("node"), given.column("copies"), given.column("raw"))

    return run


def chord(least: float) -> float:
    return math.sqrt(max(2 - 2 * least, 0)) + _SLACK


def _reached(layout: Layout, cells: np.ndarray, rows: np.ndarray, least: float) -> set[int]:
    """The cells in which a partner of any of ``rows`` could live."""
    found = set(np.unique(cells).tolist())
    for a in [c for c in found if c >= 0]:
        gap = np.sqrt(((layout.centroids - layout.centroids[a]) ** 2).sum(1))
        own = rows[cells == a]
        for at in range(0, len(own), _ROWS):
            near = own[at:at + _ROWS] @ layout.centroids.T
            found.update(np.flatnonzero((near[:, [a]] - near).min(0) <= chord(least) * gap + _SLACK).tolist())
    return found


def _packed(layout: Layout, least: float):
    def run(given: pa.Table) -> pa.Table:
        given = given.sort_by([("cell", "ascending"), ("node", "ascending")]).combine_chunks()
        dim, raws = given.column("dim")[0].as_py(), given.column("raw").to_pylist()
        cells = given.column("cell").to_numpy()
        codes = np.unique([x or "" for x in given.column("label").to_pylist()], return_inverse=True)[1].astype("<i4")
        reach = sorted(_reached(layout, cells, _units(raws, dim), least)) if cells[-1] >= 0 else [-1]
        if len({len(raw) for raw in raws}) > 1:
            raws = [np.frombuffer(raw, "<f4").astype("<f8").tobytes() if len(raw) == 4 * dim else raw for raw in raws]
        return pa.Table.from_batches([batch(
            _PACKED, *([given.column(c)[0].as_py()] for c in ("group", "block", "dim")), [cells.astype("<i4").tobytes()],
            [codes.tobytes()], *([given.column(c).to_numpy().astype("<i8").tobytes()] for c in ("node", "copies")),
            [b"".join(raws)], [np.unique(cells).tolist()], [reach])])

    return run


class Block:
    """A packed block's vectors as units, and the products of floats that bound their cosines."""

    def __init__(self, given: dict, layout: Layout):
        self.number, dim = given["block"], given["dim"]
        # Copies, so that a block that is kept for further pairs does not keep all that came with it.
        self.nodes, self.copies = (np.frombuffer(given[c], "<i8").copy() for c in ("nodes", "copies"))
        self.labels = np.frombuffer(given["labels"], "<i4").copy()
        raw, n = given["raw"], len(self.nodes)
        floats = len(raw) == 4 * dim * n
        self.rows = (_unit_floats if floats else unit)(np.frombuffer(raw, "<f4" if floats else "<f8").reshape(n, dim))
        lead = self.rows @ layout.basis if layout.basis.shape[0] == dim else self.rows
        self.lead = np.empty((n, lead.shape[1] + 1), np.float32)
        self.lead[:, :-1] = lead
        self.lead[:, -1] = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", lead, lead), 0))
        cells = np.frombuffer(given["cells"], "<i4")
        ends = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), n]
        self.cells = [(int(cells[a]), slice(a, b)) for a, b in zip(ends, ends[1:], strict=False)]


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The lowest index reachable from each of ``n`` by the links ``a``-``b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


class Forest:
    """Counts and a spanning forest of links between ``n`` vectors; holds a bounded number of links."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.counts = copies, np.zeros(len(copies), np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.counts, a, self.copies[b])
        np.add.at(self.counts, b, self.copies[a])
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > len(self.copies) + _EDGES:
            root = self.roots()
            low = np.flatnonzero(root != np.arange(len(root)))
            self.a, self.b, self.held = [low], [root[low]], len(low)

    def roots(self) -> np.ndarray:
        return _roots(np.concatenate(self.a), np.concatenate(self.b), len(self.copies))


def _near(x: Block, i: np.ndarray, y: Block, j: np.ndarray, least: float, lead_x, lead_y, space) -> tuple:
    """Pairs of the rows ``i`` of ``x`` and ``j`` of ``y`` at ``least`` or more, as indices of these."""
    bound = np.float32(least - (x.lead.shape[1] + 8) * 2e-7)
    upper = space[:len(i) * len(j)].reshape(len(i), len(j))
    np.matmul(lead_x, lead_y.T, out=upper)
    some = np.flatnonzero(upper.max(1) >= bound)
    a, b = np.nonzero(upper[some] >= bound)
    if 4 * len(a) > upper.size:
        return np.nonzero(x.rows[i] @ y.rows[j].T >= least)
    a = some[a]
    step = max(1, (_ROOM >> 2) // x.rows.shape[1])
    sure = [np.einsum("ij,ij->i", x.rows[i[a[at:at + step]]], y.rows[j[b[at:at + step]]]) >= least
            for at in range(0, len(a), step)]
    keep = np.concatenate([np.empty(0, bool), *sure])
    return a[keep], b[keep]


def meetings(x: Block, y: Block, layout: Layout, least: float):
    """The pairs of rows that could be in reach, as rows of ``x`` and of ``y``, their leading parts, and whether
    both are the same cell; at most a tile at once."""
    reach = chord(least)
    cells = sorted({c for c, _ in [*x.cells, *y.cells] if c >= 0})
    to = layout.centroids[cells]
    # Cosines to the centroids; a difference of two, over their gap, is a projection on the line through both.
    near_x = dict(zip(cells, to @ x.rows.T, strict=True)) if cells else {}
    near_y = near_x if x is y or not cells else dict(zip(cells, to @ y.rows.T, strict=True))
    for s, (a, own) in enumerate(x.cells):
        for t, (b, other) in enumerate(y.cells):
            twice = x is y and s == t
            if x is y and t < s:
                continue
            gap = 0 if a == b else math.dist(layout.centroids[a], layout.centroids[b])
            if gap > _APART:
                from_x = (near_x[a][own] - near_x[b][own]) / gap
                from_y = (near_y[b][other] - near_y[a][other]) / gap
                i = np.flatnonzero(from_x <= reach - from_y.min())
                j = np.flatnonzero(from_y <= reach - from_x.min())
                i, j = i[from_x[i].argsort()], j[from_y[j].argsort()]
                from_x, from_y = from_x[i], from_y[j]
                i, j = i + own.start, j + other.start
            else:
                i, j = np.arange(own.start, own.stop), np.arange(other.start, other.stop)
                from_x, from_y = np.zeros(len(i)), np.zeros(len(j))
            lead_x, lead_y = x.lead[i], y.lead[j]
            for at in range(0, len(i), _TILE):
                end = int(np.searchsorted(from_y, reach - from_x[at], "right"))
                if not end:
                    break
                for start in range(at if twice else 0, end, _SPAN):
                    stop = min(start + _SPAN, end)
                    yield i[at:at + _TILE], j[start:stop], lead_x[at:at + _TILE], lead_y[start:stop], twice


def compare(x: Block, y: Block, layout: Layout, least: float) -> pa.RecordBatch | None:
    """The links between two blocks, or inside one: nodes with their number of links and a root."""
    same = x is y
    nodes = x.nodes if same else np.r_[x.nodes, y.nodes]
    forest = Forest(x.copies if same else np.r_[x.copies, y.copies])
    space = np.empty(_TILE * _SPAN, np.float32)
    for i, j, lead_x, lead_y, twice in meetings(x, y, layout, least):
        a, b = _near(x, i, y, j, least, lead_x, lead_y, space)
        a, b = i[a], j[b]
        if len(a):
            keep = x.labels[a] == y.labels[b]
            if twice:
                keep &= a < b
            if keep.any():
                forest.add(a[keep], b[keep] if same else b[keep] + len(x.nodes))
    hit = np.flatnonzero(forest.counts)
    if not len(hit):
        return None
    return batch(_LINKED, nodes[hit], forest.counts[hit], nodes[forest.roots()[hit]])


def _compared(layout: Layout, least: float):
    """For rows of one block, or of two, whose columns come one after the other."""
    def run(batches):
        x = None
        for given in batches:
            for n in range(given.num_rows):
                # Bytes stay where they were received.
                row = [c[n].as_buffer() if pa.types.is_binary(c.type) else c[n].as_py() for c in given.columns]
                sides = [dict(zip(_BLOCK, row[at:], strict=False)) for at in range(0, len(row), len(_BLOCK))]
                if x is None or x.number != sides[0]["block"]:
                    x = Block(sides[0], layout)
                found = compare(x, x if len(sides) == 1 else Block(sides[1], layout), layout, least)
                if found is not None:
                    yield found

    return run


def _bundles(layout: Layout) -> list[tuple[int, int, int]]:
    """First and last block of neighbouring groups that have several, up to ``_BUNDLE`` bytes, and their bytes."""
    groups: dict[int, list[int]] = {}
    for (group, _), (first, many) in layout.blocks.items():
        low, high = groups.get(group, (first, first))
        groups[group] = [min(low, first), max(high, first + many - 1)]
    found: list[tuple[int, int, int]] = []
    for low, high in sorted(x for x in groups.values() if x[0] < x[1]):
        size = 4 * _ROOM * (high - low + 1)
        if found and found[-1][2] + size <= _BUNDLE:
            found[-1] = found[-1][0], high, found[-1][2] + size
        else:
            found.append((low, high, size))
    return found


def _links(packed: DataFrame, layout: Layout, least: float) -> DataFrame:
    """Links inside every block, and between the blocks of a group where one could reach the other."""
    run = _compared(layout._replace(groups={}, shared={}, blocks={}), least)
    meet = None
    for low, high, size in _bundles(layout):
        # Blocks are sorted in their files, whose other row groups are skipped.
        own = packed.where(F.col("block").between(low, high)).coalesce(
            min(max(4, math.ceil(size / _SIDE)), high - low + 1))
        x, y = (own.select(*(F.col(c).alias(f"{side}_{c}") for c in ("group", *_BLOCK, "home", "reach")))
                for side in "xy")
        # A block is left in half of its pairs, right in the others, so that tasks are alike.
        even = (F.col("x_block") + F.col("y_block")) % 2 == 0
        pairs = x.join(y.hint("shuffle_replicate_nl"), (F.col("x_group") == F.col("y_group"))
                       & (F.col("x_block") != F.col("y_block")) & (even == (F.col("x_block") < F.col("y_block")))
                       & F.arrays_overlap("x_reach", "y_home") & F.arrays_overlap("y_reach", "x_home")).select(
                           *(f"{side}_{c}" for side in "xy" for c in _BLOCK))
        meet = meet.unionByName(pairs) if meet else pairs
    found = packed.select(*_BLOCK).mapInArrow(run, _sql(_LINKED))
    return found.unionByName(meet.mapInArrow(run, _sql(_LINKED))) if meet else found


def near_groups(vectors: DataFrame, least: float = 0.93, per_cell: int = 2048, fit_rows: int = 8192,
                max_cells: int = 1024, block: int = 16384) -> DataFrame:
    """One row per vector: vec_id, row, n_links, component_id, kept."""
    spark = vectors.sparkSession
    embedding = F.col("embedding")
    if vectors.schema["embedding"].dataType.simpleString() != "array<float>":
        embedding = embedding.cast("array<double>")
    own = with_row(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        embedding.alias("embedding")), "row").select("vec_id", "row", "label", "embedding")
    with settings(spark, {_ARROW_ROWS: str(_ROWS)}):
        own = written(own.mapInArrow(lambda batches: map(_read, batches), _sql(_READ)), "vectors")
        comparable = own.where("digest is not null")
        distinct = written(comparable.groupBy("digest", "label", "dim", "raw").agg(
            F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id")),
            "distinct")
        layout = fit_layout(distinct, least, per_cell, fit_rows, max_cells)
        placing = distinct.select("label", "dim", "node", "copies", "raw")
        layout = with_blocks(layout, placing, block)
        # A row is a block, so row groups and batches are cut by bytes and by rows.
        packed = written(placing.mapInArrow(_dealt(layout), _sql(_DEALT)).groupBy("block").applyInArrow(
            _packed(layout, least), _sql(_PACKED)), "blocks", **{
                "compression": "none", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1",
                "parquet.page.size.row.check.min": "1"})
    with settings(spark, {_ARROW_ROWS: "1", "spark.sql.files.maxPartitionBytes": str(_SIDE)}):
        found = written(_links(packed, layout, least), "links")

    joined = components(found, "node", "root").withColumnRenamed("component", "class")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.select("digest", "node", "copies", "least_id").join(counts, "node", "left").join(
        joined, "node", "left").withColumn("class", F.coalesce("class", "node"))
    first = nodes.groupBy("class").agg(F.min("least_id").alias("component_id"))
    labelled = written(nodes.join(first, "class").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classes")
    linked = comparable.select("vec_id", "row", "digest").join(labelled, "digest").select(
        "vec_id", "row", "n_links", "component_id")
    alone = own.where("digest is null").select(
        "vec_id", "row", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
