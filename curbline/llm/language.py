"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads UTF-8 bytes in windows of ``WINDOW`` from both ends, labels
every byte with a probability per language, and a document's probabilities are
the means over all its bytes. The whole text is read. It is trained in numpy
by backpropagation through time on windows of labelled texts: at most
``texts_per_language`` texts for each language, chosen by hash, and at most
``windows_per_text`` windows of each; this is the only sample.

Activations are softsign, x / (1 + |x|), and the gates are its half plus a half:
the same gradients' shape as tanh at a fraction of its cost.

A text that is null or has no letter is ``und`` with score 0; so is every text
when there is no labelled one. Ties go to the language first in order. Repeated
rows are judged each, an empty table gives an empty result, and other columns of
the input pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import byte_values, extended, fresh

WINDOW, HIDDEN, UNKNOWN = 96, 12, "und"
LANES = 2048


@dataclass
class Network:
    """``forward`` and ``backward`` hold (byte table 256 x 3H, recurrent 3H x H); gates are z, r, candidate."""

    languages: list[str]
    forward: list[np.ndarray]
    backward: list[np.ndarray]
    out: list[np.ndarray]  # languages x H for each direction, and the bias

    def parameters(self) -> list[np.ndarray]:
        return [*self.forward, *self.backward, *self.out]


def new_network(languages: list[str], hidden: int = HIDDEN, seed: int = 3) -> Network:
    pick = np.random.default_rng(seed)

    def noise(*shape, scale):
        return (pick.standard_normal(shape) * scale).astype(np.float32)

    def direction():
        return [noise(256, 3 * hidden, scale=0.5), noise(3 * hidden, hidden, scale=0.4)]

    n = len(languages)
    return Network(languages, direction(), direction(),
                   [noise(n, hidden, scale=0.3), noise(n, hidden, scale=0.3), np.zeros((n, 1), np.float32)])


def _softsign(x: np.ndarray, room: np.ndarray) -> None:
    np.abs(x, out=room)
    room += 1
    x /= room


def _read(weights, data: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, H, N) of one direction over ``data`` (T, N); ``keep`` gathers what the gradient needs."""
    table, recurrent = weights
    steps, n = data.shape
    hidden = recurrent.shape[1]
    kind = recurrent.dtype
    states = np.zeros((steps + 1, hidden, n), kind)
    gates, room = np.empty((3 * hidden, n), kind), np.empty((3 * hidden, n), kind)
    for t in range(steps):
        given = table.take(data[t], axis=0).T
        np.dot(recurrent, states[t], out=gates)
        zr, c = gates[:2 * hidden], gates[2 * hidden:]
        inner = c.copy() if keep is not None else None
        zr += given[:2 * hidden]
        slope_zr = 0.5 / (1 + np.abs(zr)) ** 2 if keep is not None else None
        _softsign(zr, room[:2 * hidden])
        zr *= 0.5
        zr += 0.5
        c *= zr[hidden:]
        c += given[2 * hidden:]
        if keep is not None:
            slope_c = 1 / (1 + np.abs(c)) ** 2
        _softsign(c, room[2 * hidden:])
        if keep is not None:
            keep.append((zr.copy(), c.copy(), inner, slope_zr, slope_c))
        c -= states[t]
        c *= zr[:hidden]
        np.add(states[t], c, out=states[t + 1])
    return states


def _probabilities(logits: np.ndarray) -> np.ndarray:
    """Softmax over the first axis, in place."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _gradient(weights, data, states, kept, into: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of one direction; ``into`` (T, H, N) is the gradient of its states."""
    table, recurrent = weights
    hidden = recurrent.shape[1]
    d_recurrent = np.zeros_like(recurrent)
    d_given = np.empty((*data.shape, 3 * hidden), table.dtype)
    carried = np.zeros_like(into[0])
    for t in range(len(data) - 1, -1, -1):
        zr, c, inner, slope_zr, slope_c = kept[t]
        z, r, before = zr[:hidden], zr[hidden:], states[t]
        d = into[t] + carried
        d_c = d * z * slope_c
        d_zr = np.concatenate([d * (c - before), d_c * inner]) * slope_zr
        d_all = np.concatenate([d_zr, d_c * r])
        d_recurrent += d_all @ before.T
        carried = d * (1 - z) + recurrent.T @ d_all
        # The candidate's input is not behind the reset gate.
        d_given[t] = np.concatenate([d_zr, d_c]).T
    d_table, seen = np.zeros_like(table), data.ravel()
    order = np.argsort(seen, kind="stable")
    found, first = np.unique(seen[order], return_index=True)
    d_table[found] = np.add.reduceat(d_given.reshape(-1, 3 * hidden)[order], first)
    return [d_table, d_recurrent]


def train(windows: list[bytes], labels: list[str], steps: int = 300, lanes: int = 192, rate: float = 0.02,
          seed: int = 5) -> Network:
    """Adam over the mean cross entropy of all positions; every language is drawn equally often."""
    languages = sorted(set(labels))
    net = new_network(languages)
    of = [np.flatnonzero([label == x for label in labels]) for x in languages]
    data = np.zeros((len(windows), WINDOW), np.uint8)
    size = np.array([min(len(w), WINDOW) for w in windows])
    for row, w in zip(data, windows, strict=True):
        row[:min(len(w), WINDOW)] = np.frombuffer(w[:WINDOW], np.uint8)
    pick = np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        wanted = pick.integers(0, len(languages), lanes)
        chosen = np.array([of[k][pick.integers(len(of[k]))] for k in wanted])
        x = data[chosen].T.astype(np.intp)
        valid = (np.arange(WINDOW)[:, None] < size[chosen]).astype(np.float32)
        kept_f: list = []
        kept_b: list = []
        ahead, back = _read(net.forward, x, kept_f), _read(net.backward, x[::-1], kept_b)
        hf, hb = ahead[1:], back[:0:-1]
        w_f, w_b, bias = net.out
        logits = np.tensordot(hf, w_f, (1, 1)) + np.tensordot(hb, w_b, (1, 1)) + bias[:, 0]  # T, N, languages
        p = _probabilities(np.moveaxis(logits, 2, 0).copy())
        p[wanted, :, np.arange(lanes)] -= 1
        p *= valid / valid.sum()
        grads = _gradient(net.forward, x, ahead, kept_f, np.tensordot(p, w_f, (0, 0)).transpose(0, 2, 1))
        grads += _gradient(net.backward, x[::-1], back, kept_b,
                           np.tensordot(p, w_b, (0, 0)).transpose(0, 2, 1)[::-1])
        grads += [np.einsum("ltn,thn->lh", p, hf), np.einsum("ltn,thn->lh", p, hb), p.sum((1, 2))[:, None]]
        pace = rate * min(1, 2 * (1 - step / (steps + 1)))
        for value, g, m, s in zip(net.parameters(), grads, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


def label_bytes(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each text: the mean probabilities over its bytes, and the share of bytes labelled with each language."""
    n = len(net.languages)
    sums, votes = np.zeros((len(texts), n)), np.zeros((len(texts), n))
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    length = np.full(len(owner), WINDOW, np.int64)
    last = np.cumsum(counts) - 1
    has = counts > 0
    length[last[has]] = sizes[has] - (counts[has] - 1) * WINDOW
    joined = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
    data = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
    w_f, w_b, bias = net.out
    for at in range(0, len(data), LANES):
        x = data[at:at + LANES].T.astype(np.intp)
        size = length[at:at + LANES]
        ahead, back = _read(net.forward, x), _read(net.backward, x[::-1])
        total, won = np.zeros((n, x.shape[1]), np.float32), np.zeros((n, x.shape[1]), np.float32)
        for t in range(WINDOW):
            p = _probabilities(w_f @ ahead[t + 1] + w_b @ back[WINDOW - t] + bias)
            inside = t < size
            total += p * inside
            won += (p == p.max(axis=0)) * inside
        for k in range(n):
            sums[:, k] += np.bincount(owner[at:at + LANES], total[k], len(texts))
            votes[:, k] += np.bincount(owner[at:at + LANES], won[k], len(texts))
    whole = np.maximum(sizes, 1)[:, None]
    return sums / whole, votes / whole


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample_windows(labelled: DataFrame, texts_per_language: int, windows_per_text: int) -> tuple[list, list]:
    """Windows and their languages, for rows (doc_id, text, lang) that may be learned from."""
    usable = labelled.where("lang is not null and text rlike '[a-zA-Z\\\\x{80}-\\\\x{10FFFF}]'").withColumn(
        "hash", F.xxhash64("doc_id", "text"))
    # Up to its bound a language has over ``texts_per_language`` different rows, save by a chance of about 1e-9, and not
    # many more: the task that ranks them sees these alone, not that many texts from every scan task.
    wanted = texts_per_language + 6 * texts_per_language ** 0.5 + 40
    bounds = usable.groupBy("lang").agg((F.lit(2.0 ** 64 * wanted) / F.count(F.lit(1)) - 2.0 ** 63).alias("bound"))
    # A row per language; the network on the driver has an output for each of them, too.
    few = usable.join(F.broadcast(bounds), "lang").where(F.col("hash").cast("double") <= F.col("bound"))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts_per_language)

    def cut(batches):
        for given in batches:
            labels, windows = [], []
            for text, lang in zip(byte_values(given.column(0)), given.column(1).to_pylist(), strict=True):
                places = list(range(0, len(text), WINDOW))
                step = max(1, len(places) // windows_per_text)
                for start in places[::step][:windows_per_text]:
                    windows.append(text[start:start + WINDOW])
                    labels.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(windows, pa.binary())],
                                             names=["lang", "bytes"])

    rows = chosen.select("text", "lang").mapInArrow(cut, "lang string, bytes binary").collect()
    rows = sorted((r["lang"], bytes(r["bytes"])) for r in rows)
    return [r[1] for r in rows], [r[0] for r in rows]


def fit(labelled: DataFrame, texts_per_language: int = 300, windows_per_text: int = 8,
        steps: int = 300) -> Network | None:
    """A network for the languages of ``labelled`` (doc_id, text, lang); None without labelled texts."""
    windows, labels = sample_windows(labelled.select("doc_id", F.col("text").cast("string").alias("text"), "lang"),
                                     texts_per_language, windows_per_text)
    return train(windows, labels, steps) if windows else None


def predict(docs: DataFrame, net: Network | None, lang: str = "lang_pred", score: str = "score",
            share: str = "byte_share") -> DataFrame:
    """``docs`` with the language, its mean probability and the share of bytes that carry its label."""
    at = docs.columns.index("text")

    def run(batches):
        for given in batches:
            names, scores, shares = [], [], []
            texts = given.column(at).to_pylist()
            known = [net is not None and has_letter(t) for t in texts]
            rows = [t.encode() for t, k in zip(texts, known, strict=True) if k]
            means, votes = label_bytes(net, rows) if rows else (None, None)
            best = iter(means.argmax(1).tolist()) if rows else iter(())
            row = 0
            for k in known:
                if not k:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    shares.append(0.0)
                    continue
                i = next(best)
                names.append(net.languages[i])
                scores.append(min(1.0, float(means[row, i])))
                shares.append(min(1.0, float(votes[row, i])))
                row += 1
            more = {lang: pa.array(names, pa.string()), score: pa.array(scores, pa.float64()),
                    share: pa.array(shares, pa.float64())}
            yield extended(pa.schema([*given.schema, (lang, pa.string()), (score, pa.float64()),
                                      (share, pa.float64())]), given, **more)

    schema = docs.withColumns({lang: F.lit(""), score: F.lit(0.0), share: F.lit(0.0)}).schema
    for f in schema.fields[len(docs.columns):]:
        f.nullable = True
    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, times_chance: float = 1.2) -> DataFrame:
    """``docs`` without those that have no letters or no language of clear probability; columns as they are.

    The network learns from the same documents' ``lang``. A document goes when its best language has less than
    ``times_chance`` times the probability that all languages would share evenly (at most one half). Where no ``lang``
    can be learned from, every document with letters stays.
    """
    net = fit(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    if net is None:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    least = min(0.5, times_chance / len(net.languages))
    lang, score, share = fresh(docs, "lang_pred"), fresh(docs, "lang_score"), fresh(docs, "lang_share")
    judged = predict(docs, net, lang, score, share)
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
