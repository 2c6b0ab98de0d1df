"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes that cover all of it.  In every chunk two
banks of learned filters are convolved with the bytes and max-pooled over all places:

* byte filters: ``WIDTH`` consecutive bytes, a learned weight for each place and byte value;
* echo filters: 16 consecutive comparisons of the bytes with the bytes ``lag`` places before, the
  weights shared by all lags of ``LAGS`` (repeated words are runs of equal bytes at some lag).

The pooled values, averaged over the document's chunks and their largest, are combined by a
logistic unit into one probability.  Training (Adam, gradients through the pooled places only)
runs on a bounded sample: at most ``rows_per_class`` labelled rows of each class of at most
``max_bytes`` bytes, taken in the order of a hash of the id.  Scoring covers every whole text.

Defined cases: a null or empty text is one chunk without bytes and gets the score of that; labels
other than 0 and 1, and labels without a document, are ignored; without training rows of both
classes every score is 0.5; repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .arrays import pieces, text_key, utf8

CHUNK, STRIDE, WIDTH, FILTERS, ECHOES = 256, 224, 4, 8, 2
LAGS = range(2, 20)
ROWS_PER_CLASS, MAX_BYTES, EPOCHS, BATCH, RATE = 1000, 16_384, 8, 32, 0.02
THRESHOLD = 0.3
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)


@dataclass
class Net:
    table: np.ndarray     # (WIDTH, 256, FILTERS)
    echo: np.ndarray      # (16, ECHOES)
    bias: np.ndarray      # (FILTERS + ECHOES,)
    out: np.ndarray       # (2 * (FILTERS + ECHOES),): weights of the mean and of the largest
    shift: np.ndarray     # (1,)

    @classmethod
    def new(cls, seed: int = 0) -> Net:
        r, n = np.random.default_rng(seed), FILTERS + ECHOES
        return cls(*(x.astype(np.float32) for x in (
            r.normal(0, 0.1, (WIDTH, 256, FILTERS)), np.full((16, ECHOES), 0.06) + r.normal(0, 0.02, (16, ECHOES)),
            np.zeros(n), r.normal(0, 0.3, 2 * n), np.zeros(1))))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]


def chunks_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, CHUNK) bytes, 0 beyond a text's end, and the first chunk of each text."""
    size = np.diff(off)
    count = np.maximum(1, -(-(size - (CHUNK - STRIDE)) // STRIDE))
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(size)), count)
    start = off[:-1][row] + (np.arange(first[-1]) - first[:-1][row]) * STRIDE
    left = off[1:][row] - start
    padded = np.concatenate((data, np.zeros(CHUNK, np.uint8)))
    x = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[start]
    return np.where(np.arange(CHUNK) < left[:, None], x, 0).astype(np.uint8), first


def pooled(net: Net, x: np.ndarray, places: bool = False):
    """Largest response of each filter in each chunk; on demand also where it stands."""
    places_n = CHUNK - WIDTH + 1
    r = np.take(net.table[0], x[:, :places_n], axis=0)
    for k in range(1, WIDTH):
        r += np.take(net.table[k], x[:, k:k + places_n], axis=0)
    halves = (_BITS @ net.echo[:8]).astype(np.float32), (_BITS @ net.echo[8:]).astype(np.float32)
    best = np.full((len(x), ECHOES), -np.inf, np.float32)
    codes = np.zeros((len(x), ECHOES, 2), np.uint8)
    for lag in LAGS:
        same = np.zeros(x.shape, bool)
        same[:, lag:] = (x[:, lag:] == x[:, :-lag]) & (x[:, lag:] != 0)
        c = np.packbits(same, axis=1)
        e = halves[0][c[:, :-1]] + halves[1][c[:, 1:]]
        if places:
            at = e.argmax(1)
            top = np.take_along_axis(e, at[:, None], 1)[:, 0]
            better = top > best
            pair = np.stack((np.take_along_axis(c, at, 1), np.take_along_axis(c, at + 1, 1)), -1)
            codes = np.where(better[..., None], pair, codes)
            best = np.where(better, top, best)
        else:
            np.maximum(best, e.max(1), out=best)
    if not places:
        return np.maximum(0, np.concatenate((r.max(1), best), 1) + net.bias)
    at = r.argmax(1)
    top = np.take_along_axis(r, at[:, None], 1)[:, 0]
    return np.concatenate((top, best), 1) + net.bias, at, codes


def combined(net: Net, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = np.diff(first)[:, None]
    mean, top = np.add.reduceat(h, first[:-1]) / n, np.maximum.reduceat(h, first[:-1])
    z = np.concatenate((mean, top), 1) @ net.out + net.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))


def scores(net: Net | None, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    if net is None:
        return np.full(len(off) - 1, 0.5)
    found = [np.zeros(0)]
    for lo, hi in pieces(off, 1 << 19):
        x, first = chunks_of(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        # a long text's chunks go through the filters in blocks
        h = np.concatenate([pooled(net, x[i:i + 2048]) for i in range(0, len(x), 2048)])
        found.append(combined(net, h, first))
    return np.concatenate(found)


def gradients(net: Net, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    raw, at, codes = pooled(net, x, places=True)
    h = np.maximum(0, raw)
    n = np.diff(first)
    d = ((combined(net, h, first) - y) / len(y)).astype(np.float32)
    width = h.shape[1]
    mean, top = np.add.reduceat(h, first[:-1]) / n[:, None], np.maximum.reduceat(h, first[:-1])
    row = np.repeat(np.arange(len(n)), n)
    dh = (d / n)[row][:, None] * net.out[:width]
    dh = dh + np.where(h == top[row], d[row][:, None] * net.out[width:], 0)
    dh = np.where(raw > 0, dh, 0).astype(np.float32)
    table, echo = np.zeros_like(net.table), np.zeros_like(net.echo)
    for f in range(FILTERS):
        for k in range(WIDTH):
            table[k, :, f] = np.bincount(x[np.arange(len(x)), at[:, f] + k], dh[:, f], 256)
    for g in range(ECHOES):
        bits = np.unpackbits(codes[:, g], axis=1).astype(np.float32)
        echo[:, g] = bits.T @ dh[:, FILTERS + g]
    return [table, echo, dh.sum(0), d @ np.concatenate((mean, top), 1), d.sum(keepdims=True)]


def train(rows: list[tuple[bytes, int]], epochs: int = EPOCHS, rate: float = RATE) -> Net | None:
    """Adam over shuffled mini-batches; the classes weigh the same."""
    y = np.array([q for _, q in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    order = np.random.default_rng(1)
    groups = [np.flatnonzero(y == c) for c in (0, 1)]
    net = Net.new()
    m, v = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()]
    t, steps = 0, max(1, epochs * max(map(len, groups)) // (BATCH // 2))
    for t in range(1, steps + 1):
        pick = np.concatenate([order.choice(g, BATCH // 2) for g in groups])
        own = [rows[i][0] for i in pick]
        off = np.concatenate(([0], np.cumsum([len(b) for b in own]))).astype(np.int64)
        x, first = chunks_of(np.frombuffer(b"".join(own), np.uint8), off)
        step = rate * (1 - 0.9 * t / steps)
        for a, g, m1, v1 in zip(net.arrays(), gradients(net, x, first, y[pick]), m, v):
            m1 += 0.1 * (g - m1)
            v1 += 0.01 * (g * g - v1)
            a -= step * (m1 / (1 - 0.9 ** t)) / (np.sqrt(v1 / (1 - 0.99 ** t)) + 1e-6)
    return net


def fold(column: str = "doc_id", n: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n))


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS,
                  max_bytes: int = MAX_BYTES) -> list[tuple[bytes, int]]:
    """The bounded sample; only rows whose crc32(doc_id) mod 5 is not 0.  An id that is labelled both 0 and 1 is
    left out; of several texts of one id the least counts."""
    usable = (labels.where((fold() != 0) & F.col("quality").isin(0, 1)).groupBy("doc_id")
              .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other"))
    chosen = [usable.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
              for c in (0, 1)]
    # at most 2 * rows_per_class rows of two numbers
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = (docs.select("doc_id", text_key().alias("text")).where(F.octet_length("text") <= max_bytes)
            .join(chosen, "doc_id").groupBy("doc_id")
            .agg(F.min("text").alias("text"), F.min("quality").cast("int").alias("quality")).collect())
    rows = sorted((r.doc_id, r.text, r.quality) for r in rows)
    return [(t.encode(), q) for _, t, q in rows]


def score(docs: DataFrame, net: Net | None, name: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the probability of label 1."""
    kept = [f for f in docs.schema.fields if f.name != name]
    docs = docs.select([f.name for f in kept])

    def task(batches):
        for b in batches:
            s = scores(net, *utf8(b.column("text")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    return docs.mapInArrow(task, StructType([*kept, StructField(name, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus score and predicted (1: kept)."""
    net = train(training_rows(docs, labels))
    return score(docs, net).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
