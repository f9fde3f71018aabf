"""Hard negatives by threshold joins in the manner of L2AP, with thresholds that fall until windows fill.

A search asks, for each anchor, for the rows whose inner product reaches the anchor's threshold. Rows
lie in blocks. In a block the dimensions are put in order of their weight, and an inverted index is
built that omits a row's last dimensions as long as the norm of that suffix times any anchor's norm stays below
the anchor's threshold: no pair can reach it on those alone. Partial scores are accumulated list by list, and a
pair is dropped once its partial score plus the product of the remaining norms is too small. The
pairs that are left are scored exactly in integers.

Positives are looked for first, at thresholds of falling shares of the product of norms, and an anchor leaves
when it has enough of them; the last round has no threshold. Each positive then opens a window of
scores, which is searched from its top: at first only a share of the way down, and to its lower end for windows
that are not full by then. Everything above a round's threshold is found, so a full window is final.

Anchors are a stated set of queries against all rows. A task compares a block of anchors with a block of
rows, both bounded and dealt by hash, whatever the labels are, and returns at most as many rows for an anchor or window
as are asked for. Nothing is collected.

Rows take part when label and vector are there, all components are finite and the scaled length is at most
2 ** 30 (see ``vectors``; longer ones would not fit the score columns). Only vectors of the same length are
compared. Repeated rows count each, also as anchors; a null id is no anchor and comes after all
others in ties; further ties go by row. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import with_row, written
from curbline.llm.vectors import whole_vectors

#: Shares of (norm of the anchor x root mean square norm of the rows) at which positives are looked for.
POSITIVE_SHARES = (0.6, 0.3, 0.15, None)
#: How far down a window is searched, as shares of its top; None is its lower end.
WINDOW_SHARES = (0.93, None)
_HIT = "anchor bigint, window int, row bigint, none int, vec_id bigint, score bigint"
_CHUNK = 8


def _suffix_norms(m: np.ndarray) -> np.ndarray:
    """Norms of m[:, d:] for d from 0 to the width."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(m), 1))], axis=1))


def reaching(x: np.ndarray, least: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (i, j, score) with the integer product score = x[i] @ y[j] >= least[i]; ``least`` may hold -inf."""
    none = np.zeros(0, np.int64)
    if not len(x) or not len(y):
        return none, none, none
    weight = np.argsort(-(y.astype(float) ** 2).sum(0), kind="stable")
    x, y = x[:, weight], y[:, weight]
    fx, fy = x.astype(float), y.astype(float)
    rest_x, rest_y = _suffix_norms(fx), _suffix_norms(fy)
    width = x.shape[1]
    # Rounding of sums stays far below a billionth of the norms' product.
    slack = 1e-9 * rest_x[:, :1] * rest_y[:, 0].max() + 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(rest_x[:, 0] > 0, (least - slack[:, 0]) / rest_x[:, 0], np.where(least <= 0, -np.inf, np.inf))
    # Indexed dimensions per row; the suffix behind them is below every anchor's need.
    indexed = (rest_y >= need.min()).sum(1)
    indexed = np.minimum(indexed, width)
    by_length = np.argsort(-indexed, kind="stable")
    indexed = indexed[by_length]
    fy, rest_y = fy[by_length], rest_y[by_length]
    lists = np.where(np.arange(width) < indexed[:, None], fy, 0.0)
    rows = int((indexed > 0).sum()) if need.min() > 0 else len(y)
    partial = np.zeros((len(x), rows))
    pairs = None
    for at in range(0, width, _CHUNK):
        end = min(at + _CHUNK, width)
        done = np.minimum(end, indexed[:rows])
        left_x, left_y = rest_x[:, done], rest_y[np.arange(rows), done]
        if pairs is None:
            reach = int((indexed > at).sum())
            if reach:
                partial[:, :reach] += fx[:, at:end] @ lists[:reach, at:end].T
            alive = partial + left_x * left_y >= least[:, None] - slack
            if alive.mean() < 0.1 if alive.size else True:
                pairs = np.nonzero(alive)
                partial = partial[pairs]
        else:
            i, j = pairs
            partial = partial + (fx[i, at:end] * lists[j, at:end]).sum(1)
            alive = partial + left_x[i, j] * left_y[j] >= least[i] - slack[i, 0]
            pairs, partial = (i[alive], j[alive]), partial[alive]
    if pairs is None:
        whole = x @ y[by_length[:rows]].T
        i, j = np.nonzero((whole >= least[:, None]) & alive) if width else np.nonzero(whole >= least[:, None])
        return i, by_length[j], whole[i, j]
    i, j = pairs[0], by_length[pairs[1]]
    score = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 1 << 15):
        part = slice(at, at + (1 << 15))
        score[part] = (x[i[part]] * y[j[part]]).sum(1)
    hit = score >= least[i]
    return i[hit], j[hit], score[hit]


def _first(window: np.ndarray, most: int, *order: np.ndarray) -> np.ndarray:
    """Places of the first ``most`` of every window by ``order``."""
    at = np.lexsort((*reversed(order), window))
    own = window[at]
    place = np.arange(len(at)) - np.searchsorted(own, own)
    return at[place < most]


def _task(most: int, same_label: bool):
    def run(windows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor", "window", "row", "none", "vec_id", "score"]
        if not len(windows) or not len(rows):
            return pd.DataFrame({c: [] for c in columns}).astype("int64")
        y = np.frombuffer(b"".join(rows["numbers"]), np.int64).reshape(len(rows), -1)
        row, none, vec_id, other = (rows[c].to_numpy() for c in ("row", "none", "vec_id", "label"))
        # The windows of an anchor are searched together, from the lowest of their bounds.
        windows = windows.sort_values("anchor", kind="stable")
        own, first, which = np.unique(windows["anchor"].to_numpy(), return_index=True, return_inverse=True)
        x = np.frombuffer(b"".join(windows["numbers"].iloc[first]), np.int64).reshape(len(own), -1)
        low, high = windows["low"].to_numpy(), windows["high"].to_numpy()
        least = np.full(len(own), np.inf)
        np.minimum.at(least, which, low)
        i, j, score = reaching(x, least, y)
        same = windows["label"].to_numpy()[first][i] == other[j]
        take = same & (own[i] != row[j]) if same_label else ~same
        i, j, score = i[take], j[take], score[take]
        by_anchor = np.argsort(i, kind="stable")
        i, j, score = i[by_anchor], j[by_anchor], score[by_anchor]
        # Every hit meets each window of its anchor.
        start = np.searchsorted(i, which)
        length = np.searchsorted(i, which, side="right") - start
        w = np.repeat(np.arange(len(which)), length)
        hit = np.arange(len(w)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
        fits = (score[hit] >= low[w]) & (score[hit] <= high[w])
        w, hit = w[fits], hit[fits]
        at = _first(w, most, -score[hit], none[j[hit]], vec_id[j[hit]], row[j[hit]])
        w, hit = w[at], hit[at]
        return pd.DataFrame({
            "anchor": own[which[w]], "window": windows["window"].to_numpy()[w], "row": row[j[hit]],
            "none": none[j[hit]], "vec_id": vec_id[j[hit]], "score": score[hit]}, columns=columns)

    return run


def _search(windows: DataFrame, rows: DataFrame, a: int, r: int, most: int, same_label: bool) -> DataFrame:
    """Of each window (anchor, window, low, high, label, numbers) the first ``most`` rows in it, with their
    ``place`` and how many were ``found``."""
    key = ["width", "anchors", "rows"]
    left = windows.select(
        F.length("numbers").alias("width"), F.pmod(F.xxhash64("anchor"), F.lit(a)).alias("anchors"),
        F.expr(f"explode(sequence(0L, {r - 1}L))").alias("rows"),
        "anchor", "window", "low", "high", "label", "numbers")
    right = rows.select(
        F.length("numbers").alias("width"), F.expr(f"explode(sequence(0L, {a - 1}L))").alias("anchors"),
        F.pmod(F.xxhash64("row"), F.lit(r)).alias("rows"), "row", "none", "vec_id", "label", "numbers")
    hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_task(most, same_label), _HIT)
    own = Window.partitionBy("anchor", "window")
    return hits.withColumn("place", F.row_number().over(own.orderBy(
        F.desc("score"), "none", "vec_id", "row"))).where(F.col("place") <= most).withColumn(
        "found", F.count(F.lit(1)).over(own))


def _filled(windows: DataFrame, bounds: list[Column], search, most: int) -> DataFrame:
    """The hits of all windows. ``bounds`` are the lower ends to search to, from high to low; a window that is
    full at one of them is final."""
    answers = []
    for at, low in enumerate(bounds):
        found = written(search(windows.withColumn("low", low)), "found")
        if at == len(bounds) - 1:
            return reduce(DataFrame.unionByName, [*answers, found])
        answers.append(found.where(F.col("found") >= most))
        full = answers[-1].select("anchor", "window").distinct()
        windows = written(windows.join(full, ["anchor", "window"], "left_anti"), "open-windows")


def _rows(vectors: DataFrame, anchors: Column) -> DataFrame:
    """row, vec_id (0 where ``none``), label, numbers as bytes, is_anchor, norm."""
    def run(batches):
        for given in batches:
            numbers = [np.array(v, np.int64) for v in given.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*given.columns[:4], given.column(5), pa.array([v.tobytes() for v in numbers], pa.binary()),
                 pa.array([float(np.sqrt((v.astype(float) ** 2).sum())) for v in numbers])],
                names=["row", "none", "vec_id", "label", "is_anchor", "numbers", "norm"])

    known = with_row(whole_vectors(vectors).where("label is not null"), "row")
    return known.select(
        "row", F.col("vec_id").isNull().cast("int").alias("none"), F.coalesce("vec_id", F.lit(0)).alias("vec_id"),
        "label", "numbers", F.coalesce(anchors, F.lit(False)).alias("is_anchor")).mapInArrow(
        run, "row bigint, none int, vec_id bigint, label bigint, is_anchor boolean, numbers binary, norm double")


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5,
                   percent: int = 80, anchor_block: int = 512, row_block: int = 2048) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on vec_id. An anchor's positives are its first ``positives`` other rows of the
    same label. Of the rows of other labels whose score is at most the positive's and at least ``percent`` per
    cent of it, the first ``negatives`` are returned; a negative positive score has none.
    """
    rows = written(_rows(vectors, anchors), "rows")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"),
                     F.avg(F.col("norm") * F.col("norm")).alias("square")).first()
    a, r = max(1, -(-about["anchors"] // anchor_block)), max(1, -(-about["n"] // row_block))
    typical = math.sqrt(about["square"] or 0.0)
    queries = rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label",
                                             "numbers", "norm")

    whole = queries.withColumn("window", F.lit(0)).withColumn("high", F.lit(math.inf))
    bounds = [F.lit(-math.inf) if share is None else F.col("norm") * share * typical for share in POSITIVE_SHARES]
    near = written(_filled(whole, bounds, lambda w: _search(w, rows, a, r, positives, True), positives), "positives")

    windows = near.where("score >= 0").select(
        "anchor", F.col("place").alias("window"), "score", F.col("none").alias("positive_none"),
        F.col("vec_id").alias("positive_id")).join(queries, "anchor").withColumn(
        "high", F.col("score").cast("double"))
    # Scores are whole numbers: the least one that is percent per cent or more.
    end = F.ceil(F.col("score").cast("decimal(20,0)") * percent / 100).cast("double")
    bounds = [end if share is None else F.greatest(end, F.col("high") * share) for share in WINDOW_SHARES]
    windows = written(windows, "windows")
    hard = _filled(windows, bounds, lambda w: _search(w, rows, a, r, negatives, False), negatives)
    return hard.select("anchor", "window", "place", "none", "vec_id", F.col("score").alias("negative_score")).join(
        windows.select("anchor", "window", "anchor_id", "positive_none", "positive_id", "score"),
        ["anchor", "window"]).select(
        "anchor_id", F.expr("if(positive_none = 1, null, positive_id)").alias("positive_id"),
        F.col("place").alias("rank"), F.expr("if(none = 1, null, vec_id)").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score")
