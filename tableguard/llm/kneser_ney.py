"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted
hash arrays that the workers map into memory.

Training (documents whose crc32(doc_id) mod 7 is not 2):

1. Word hashes are counted (summed in each task before the shuffle), split by their highest bits into
   ``shards`` and written as sorted arrays with their counts.  A word's number is its place in them.
2. Bigrams are pairs of numbers in one long.  Each task sums blocks of ``BLOCK`` tokens; the rest is
   shuffled by (range of the first word, part of the second word), so a very common first word is split
   over ``SPLIT`` shards; each shard becomes a sorted array of bigrams with their counts.
3. Each shard also reports, for its first and second words, how many different bigrams they have with
   count 1, 2 and 3 or more; summed, these give the weights of contexts and the continuation counts,
   written as arrays by word number.  The four counts of counts give the three discounts.

Scoring looks each block's distinct words and bigrams up in the mapped arrays:
``P(w|u) = max(c(uw) - D, 0) / c(u) + g(u) P1(w)``, with
``P1(w) = max(N(.w) - D', 0) / N(..) + g' / (V + 1)`` for N(.w) different words before w.  An
unknown word has N = 0, an unknown context leaves P1.  The model grows with the corpus and no task or
driver holds it; the driver sees file names and sums.  Counts are 64 bits wide where 32 do not do; more than
2^32 - 1 distinct words raise an error.

Defined cases: a null or empty text is the end token alone; a null doc_id is in the training part;
rows that repeat count each time; without training rows every probability is 1 / (V + 1) = 1.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import batch_of, checkpoint_root, materialize, pieces, space_words, text_key, utf8
from .shared_arrays import load, save

BLOCK, SHARDS, SPLIT = 4 << 20, 64, 8
NARROW = (1 << 32) - 1      # the largest count in 32 bits, and the largest number of a word in a bigram's key
END = np.uint64(0x9D39247E33776D41)
_COUNTS = pa.schema([("k", pa.int64()), ("c", pa.int64())])
_FILES = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64()),
                    ("n3", pa.int64()), ("n4", pa.int64()), ("keys", pa.string()), ("counts", pa.string())])
_FILES_DDL = "kind int, id long, n1 long, n2 long, n3 long, n4 long, keys string, counts string"


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the rows, each row closed by the end token, and where each row begins."""
    words, row = space_words(data, off)
    first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(off) - 1) + 1)))
    out = np.full(first[-1], END)
    out[np.arange(len(words)) + row] = words
    return out, first


def token_blocks(batches):
    for b in batches:
        data, off = utf8(b.column("text"))
        for lo, hi in pieces(off, 1 << 18):
            yield tokens(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])


def summed(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    k = np.concatenate(keys)
    order = np.argsort(k, kind="stable") if counts is not None else None
    k = np.sort(k) if order is None else k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    if counts is None:
        return k[first], np.diff(np.append(first, len(k)))
    return k[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(k) else np.zeros(0, np.int64)


def _sums(blocks, block: int):
    """(k, c) batches, summed over about ``block`` keys at a time."""
    held, size = [], 0
    for keys in blocks:
        held.append(keys)
        size += len(keys)
        if size >= block:
            yield batch_of(_COUNTS, [pa.array(x.view(np.int64)) for x in summed(held)])
            held, size = [], 0
    if held:
        yield batch_of(_COUNTS, [pa.array(x.view(np.int64)) for x in summed(held)])


class Words:
    """Word numbers and counts; ``files``: (first number, keys, counts) of each shard in order."""

    def __init__(self, files: list[tuple[int, str, str]], size: int):
        self.first = np.array([f[0] for f in files], np.int64)
        self.parts = [(load(k, np.uint64), load(c, np.int64)) for _, k, c in files]
        self.size, self.shift = size, np.uint64(64 - (len(files) - 1).bit_length())

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count or 0) of sorted words."""
        number, count = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        edge = np.searchsorted(words >> self.shift, np.arange(len(self.parts) + 1, dtype=np.uint64))
        for i, (keys, counts) in enumerate(self.parts):
            w = words[edge[i]:edge[i + 1]]
            if len(w) and len(keys):
                at = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
                hit = keys[at] == w
                number[edge[i]:edge[i + 1]] = np.where(hit, at + self.first[i], -1)
                count[edge[i]:edge[i + 1]] = np.where(hit, counts[at], 0)
        return number, count


def numbered(words: Words, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, back = np.unique(t, return_inverse=True)
    number, count = words.look_up(u)
    return number[back], count[back]


def contexts(number: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    before = np.empty_like(number)
    before[1:] = number[:-1]
    before[first[:-1]] = start
    return before


def shard_of(u: np.ndarray, w: np.ndarray, size: int, ranges: int) -> np.ndarray:
    return u * ranges // (size + 1) * SPLIT + w % SPLIT


def load_counts(path: str, n: int) -> np.ndarray:
    """Counts of ``n`` bigrams; a shard with a count beyond 32 bits holds 64 for each."""
    narrow = load(path, np.uint32)
    return narrow if len(narrow) == n else narrow.view(np.int64)


# -- training --------------------------------------------------------------------------------
def count_words(train: DataFrame, folder: str, shards: int) -> tuple[list[tuple[int, str, str]], int, int]:
    """Files of the word arrays, V and N."""
    rows = train.mapInArrow(lambda b: _sums((t for t, _ in token_blocks(b)), BLOCK), "k long, c long")
    rows = rows.groupBy("k").agg(F.sum("c").alias("c"))
    shift = 64 - (shards - 1).bit_length()
    rows = rows.withColumn("shard", F.shiftrightunsigned("k", shift)).repartition("shard")
    files = materialize(rows.mapInArrow(_writer(folder, 0), _FILES_DDL), "words").collect()
    by_shard = {r.id: r for r in files}
    empty = save(folder, np.zeros(0, np.int64))
    made, size, total = [], 0, 0
    for i in range(1 << (64 - shift)):
        r = by_shard.get(i)
        made.append((size, r.keys, r.counts) if r else (size, empty, empty))
        size, total = size + (r.n1 if r else 0), total + (r.n2 if r else 0)
    if size > NARROW:
        raise ValueError(f"{size} distinct words: a bigram's key holds two numbers of 32 bits")
    return made, size, total


def _writer(folder: str, kind: int):
    """Write each shard's sorted keys and counts.  Kind 0, words: a row with their number and sum.  Kind 1,
    bigrams: a row with the counts of counts, and rows of kind 2 and 3 for first and second words."""
    def task(batches):
        held: dict[int, list] = {}
        for b in batches:
            k, c, s = (b.column(x).to_numpy(zero_copy_only=False) for x in ("k", "c", "shard"))
            order = np.argsort(s, kind="stable")
            cut = np.flatnonzero(np.diff(s[order])) + 1
            for part in np.split(order, cut) if len(s) else ():
                held.setdefault(int(s[part[0]]), []).append((k[part].view(np.uint64), c[part]))
        for shard, parts in held.items():
            keys, counts = summed([p[0] for p in parts], [p[1] for p in parts])
            wide = kind == 0 or counts.max(initial=0) > NARROW
            names = save(folder, keys), save(folder, counts.astype(np.int64 if wide else np.uint32))
            if kind == 0:
                yield batch_of(_FILES, [[0], [shard], [len(keys)], [int(counts.sum())], [0], [0], [names[0]], [names[1]]])
                continue
            of = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
            yield batch_of(_FILES, [[1], [shard], *([x] for x in of), [names[0]], [names[1]]])
            for side, ids in ((2, keys >> np.uint64(32)), (3, keys & np.uint64(0xFFFFFFFF))):
                u, back = np.unique(ids, return_inverse=True)
                n = [np.bincount(back[sel], minlength=len(u)) for sel in (counts == 1, counts == 2, counts > 2)]
                none = pa.nulls(len(u), pa.string())
                yield batch_of(_FILES, [np.full(len(u), side, np.int32), pa.array(u.view(np.int64)), *map(pa.array, n),
                                        np.zeros(len(u), np.int64), none, none])
    return task


def count_bigrams(train: DataFrame, folder: str, files, size: int, ranges: int) -> DataFrame:
    def task(batches):
        words = Words(files, size)

        def keys():
            for t, first in token_blocks(batches):
                w, _ = numbered(words, t)
                yield contexts(w, first, size).astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)

        for b in _sums(keys(), BLOCK):
            k = b.column("k").to_numpy()
            s = shard_of(k >> 32, k & 0xFFFFFFFF, size, ranges)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=["k", "c", "shard"])

    rows = train.mapInArrow(task, "k long, c long, shard long").repartition(ranges * SPLIT, "shard")
    return materialize(rows.mapInArrow(_writer(folder, 1), _FILES_DDL), "bigrams")


def word_arrays(found: DataFrame, folder: str, size: int, parts: int) -> dict[int, list]:
    """By side (2: first words, 3: second words): (first number, file) of the arrays (n1, n2, n3+) by number."""
    width = -(-(size + 1) // parts)
    rows = (found.where("kind > 1").groupBy("kind", "id")
            .agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in (1, 2, 3)))
            .withColumn("part", F.col("kind") * parts + F.floor(F.col("id") / width).cast("int")).repartition("part"))

    def task(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            x = [b.column(c).to_numpy(zero_copy_only=False) for c in ("part", "id", "n1", "n2", "n3")]
            for p in np.unique(x[0]).tolist():
                own = x[0] == p
                a = held.setdefault(p, np.zeros((width, 3), np.uint32))
                a[x[1][own] - p % parts * width] = np.stack([y[own] for y in x[2:]], 1)
        for p, a in held.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "file": [save(folder, a)],
                                              "types": [int(a.sum(dtype=np.int64))],
                                              **{f"c{i}": [int((a.sum(1) == i).sum())] for i in (1, 2, 3, 4)},
                                              "more": [int((a.sum(1) > 2).sum())]})

    names = ["file", "types", "c1", "c2", "c3", "c4", "more"]
    made = materialize(rows.mapInArrow(task, "part int, file string, types long, c1 long, c2 long, c3 long, c4 long, more long"),
                       "word-arrays").collect()
    by = {r.part: r for r in made}
    return {side: [tuple(by[side * parts + i][n] for n in names) if side * parts + i in by else None
                   for i in range(parts)] for side in (2, 3)} | {"width": width}


def discounts(n: list[int]) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more, from the counts of counts 1 to 4 (each at least 1)."""
    n1, n2, n3, n4 = (max(1, x) for x in n)
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))])


def train(docs: DataFrame, shards: int = SHARDS) -> dict:
    """The model: file names and sums."""
    folder = f"{checkpoint_root(docs.sparkSession)}/lm-{uuid.uuid4().hex}"
    part = docs.where(~held_out()).select(text_key().alias("text"))
    files, size, total = count_words(part, folder, shards)
    ranges = max(1, shards // SPLIT, total // (SPLIT * BLOCK))
    found = count_bigrams(part, folder, files, size, ranges)
    arrays = word_arrays(found, folder, size, max(1, shards // 8))
    rows = found.where("kind = 1").collect()
    of = [sum(r[f"n{i}"] for r in rows) for i in (1, 2, 3, 4)]
    second = [x for x in arrays[3] if x]
    types = sum(x[1] for x in second)
    continuation = discounts([sum(x[i + 1] for x in second) for i in (1, 2, 3, 4)])
    with_one, with_two, with_more = (sum(x[i] for x in second) for i in (2, 3, 6))
    left = (continuation[1:] @ [with_one, with_two, with_more]) / types if types else 1.0
    return {"files": files, "size": size, "total": total, "ranges": ranges, "arrays": arrays, "types": types,
            "starts": part.count(), "bigrams": {r.id: (r.keys, r.counts) for r in rows},
            "d2": discounts(of).tolist(), "d1": continuation.tolist(),
            "left": left}


# -- scoring ---------------------------------------------------------------------------------
class Model:
    def __init__(self, m: dict):
        self.m, self.words = m, Words(m["files"], m["size"])
        self.width = m["arrays"]["width"]
        self.d2, self.d1 = np.array(m["d2"]), np.array(m["d1"])

    def types_of(self, side: int, ids: np.ndarray) -> np.ndarray:
        """(n1, n2, n3+) of the words with these numbers; zeros for -1."""
        out = np.zeros((len(ids), 3))
        part = np.where(ids < 0, -1, ids // self.width)
        for p in np.unique(part[part >= 0]).tolist():
            if entry := self.m["arrays"][side][p]:
                a = load(entry[0], np.uint32).reshape(-1, 3)
                own = part == p
                out[own] = a[ids[own] - p * self.width]
        return out

    def counts_of(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Counts of bigrams, sorted by (u, w) and known in both words."""
        out = np.zeros(len(u), np.int64)
        key = u.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)
        shard = shard_of(u, w, self.m["size"], self.m["ranges"])
        order = np.argsort(shard, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else ():
            if files := self.m["bigrams"].get(int(shard[own[0]])):
                keys = load(files[0], np.uint64)
                at = np.minimum(np.searchsorted(keys, key[own]), len(keys) - 1)
                out[own] = np.where(keys[at] == key[own], load_counts(files[1], len(keys))[at], 0)
        return out

    def unigram(self, ids: np.ndarray) -> np.ndarray:
        """P1 of the words with these numbers (-1: unknown)."""
        types, size = self.m["types"], self.m["size"]
        if not types:
            return np.full(len(ids), 1 / (size + 1))
        n = self.types_of(3, ids).sum(1)
        return np.maximum(0, n - self.d1[np.minimum(n, 3).astype(int)]) / types + self.m["left"] / (size + 1)

    def log10(self, w: np.ndarray, count: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 P of each token after the one before it."""
        start = self.m["size"]
        u = contexts(w, first, start)
        c = contexts(count, first, self.m["starts"]).astype(float)      # a word's count is its count as context
        ids, back = np.unique(w, return_inverse=True)
        p = self.unigram(ids)[back]
        ctx, cback = np.unique(u, return_inverse=True)
        weight = (self.types_of(2, ctx) @ self.d2[1:])[cback]
        seen = (u >= 0) & (c > 0)
        both = np.flatnonzero(seen & (w >= 0))
        pair, pback = np.unique(u[both] << 32 | w[both], return_inverse=True)
        n = np.zeros(len(w), np.int64)
        n[both] = self.counts_of(pair >> 32, pair & 0xFFFFFFFF)[pback]
        c = np.where(seen, c, 1)
        full = np.maximum(0, n - self.d2[np.minimum(n, 3)]) / c + weight / c * p
        return np.log10(np.where(seen, full, p))


def score(docs: DataFrame, m: dict) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64())])

    def task(batches):
        model = Model(m)
        for b in batches:
            data, off = utf8(b.column("text"))
            for lo, hi in pieces(off, 1 << 21):
                t, first = tokens(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                w, count = numbered(model.words, t)
                base = np.log10((count + 1.0) / (m["total"] + 1.0 * (m["size"] + 1)))
                yield batch_of(schema, [
                    b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo),
                    np.diff(first), np.add.reduceat((count > 0).astype(np.int64), first[:-1]),
                    np.full(hi - lo, m["total"]), np.add.reduceat(base, first[:-1]),
                    np.add.reduceat(model.log10(w, count, first), first[:-1])])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text_key().alias("text"))
    return rows.mapInArrow(task, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double")


def score_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Train on the training part and score every document."""
    return score(docs, train(docs, shards))
