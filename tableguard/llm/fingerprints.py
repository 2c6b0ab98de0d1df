"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are parsed level by level.  At each level the symbols are labelled by
deterministic coin tossing: the lowest bit in which a symbol differs from the one before it, twice
its place plus its value; repeated until labels are below 8.  Phrases begin at local maxima of
the labels and where a run of equal symbols begins or ends, so a boundary depends on a constant
number of symbols around it, and equal substrings get equal phrases in their interior wherever they
stand.  A phrase's name is a 64-bit hash of its symbols; names are the next level's symbols.

The fingerprint is the ``KEEP`` smallest hashes of the distinct names of level ``LEVEL``, in
hex; two fingerprints' likeness estimates the Jaccard similarity of the name sets from the smallest
hashes of their union (1 for two empty texts, 0 if one is empty).

``with_next`` puts every document beside the next one in descending doc_id (after the last: the
first) without gathering them: the ids are cut into ranges at approximate quantiles, each range is
sorted by itself, and the first document of every range is also sent to the range before it.  Texts
are shuffled once.

Defined cases: a null text is empty; rows that tie in doc_id are ordered by a hash of the text; null ids come
last; a table of one row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import batch_of, mix, powers, text_key, texts

LEVEL, KEEP = 2, 64
ROWS_PER_RANGE, MAX_RANGES = 2000, 10_000
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])
DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def toss(label: np.ndarray, before: np.ndarray) -> np.ndarray:
    """2 * (lowest differing bit) + its value in ``label``; 0 where nothing differs."""
    differ = label ^ before
    low = differ & (~differ + label.dtype.type(1))
    place = np.frexp(low.astype(np.float64))[1] - 1            # exact: one bit is set
    tossed = 2 * place + ((label & low) != 0)
    return np.where(differ != 0, tossed, 0).astype(np.uint8)


#: One toss of two bytes (and so of two labels) by table, the rule above applied to all pairs.
TOSS = toss(np.repeat(np.arange(256, dtype=np.uint16), 256), np.tile(np.arange(256, dtype=np.uint16), 256))


def shifted(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each symbol's predecessor; a row's first symbol has 0."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = 0
    return before


def boundaries(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a phrase begins.  first: where rows begin."""
    before = shifted(symbols, first)
    if symbols.dtype == np.uint8:
        label = TOSS[symbols.astype(np.uint16) << 8 | before]
    else:
        label = toss(symbols, before)                            # below 128
        label = TOSS[label.astype(np.uint16) << 8 | shifted(label, first)]
    for _ in range(2):
        label = TOSS[label.astype(np.uint16) << 8 | shifted(label, first)]
    equal = symbols == before
    equal[first] = False
    after = np.append(label[1:], np.uint8(255))
    after[first[1:] - 1] = 255                                   # no phrase of a row's last symbol alone
    begin = np.zeros(len(symbols), bool)
    begin[1:] = (label[1:] > label[:-1]) & (label[1:] >= after[1:])
    begin[1:] |= equal[1:] != equal[:-1]
    begin[first] = True
    return begin


def names(codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of each phrase's symbols, the same wherever it stands."""
    n = len(codes)
    total = np.add.reduceat(codes * powers(_BASE, n)[:n], start)
    length = np.diff(np.append(start, n)).astype(np.uint64)
    return mix(total * powers(_INVERSE, n)[start] + length)


_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def parse(data: np.ndarray, first: np.ndarray, levels: int = LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the last level and where each row's begin; rows must not be empty."""
    symbols = data
    for level in range(levels):
        start = np.flatnonzero(boundaries(symbols, first))
        codes = _CODES[symbols] if level == 0 else symbols
        symbols, first = names(codes, start), np.searchsorted(start, first)
    return symbols, first


def sketch(rows: list[bytes], keep: int = KEEP, levels: int = LEVEL) -> list[np.ndarray]:
    """The smallest hashes of each row's distinct phrase names."""
    found = [np.zeros(0, np.uint64)] * len(rows)
    full = [i for i, r in enumerate(rows) if r]
    if full:
        data = np.frombuffer(b"".join(rows[i] for i in full), np.uint8)
        first = np.cumsum([0] + [len(rows[i]) for i in full[:-1]])
        symbols, first = parse(data, first, levels)
        for i, a, b in zip(full, first.tolist(), [*first[1:].tolist(), len(symbols)]):
            found[i] = np.unique(mix(symbols[a:b]))[:keep]
    return found


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    again = np.append(both[1:] == both[:-1], False)             # in both; stands on the first of the two
    fresh = np.concatenate(([True], ~again[:-1]))
    return float(again[fresh][:keep].mean())


def hexed(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE, most: int = MAX_RANGES) -> DataFrame:
    """(part, guest, doc_id, tie, text): within a part, rows in descending doc_id; a guest row is
    the first of the part that follows and closes this one."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text"))
    n = min(most, 1 + rows.count() // rows_per_range)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    cuts = F.array(*(F.lit(c) for c in sorted(set(cuts or [])))).cast("array<long>")
    # part 0 holds the largest ids; null ids are a part of their own, the last
    part = F.when(F.col("doc_id").isNull(), F.size(cuts) + 1).otherwise(
        F.size(F.filter(cuts, lambda c: c > F.col("doc_id"))))
    rows = rows.withColumn("part", part).withColumn("tie", F.xxhash64("text"))
    # the first row of each part: one small row for each range
    firsts = rows.groupBy("part").agg(F.max(F.struct("doc_id", (-F.col("tie").cast("decimal(20)")).alias("tie"))).alias("top"))
    firsts = sorted((r.part, r.top.doc_id, int(-r.top.tie)) for r in firsts.collect())
    size = firsts[-1][0] + 1 if firsts else 0
    first_id, first_tie, host = [None] * size, [None] * size, [None] * size
    for i, (p, doc_id, tie) in enumerate(firsts):
        first_id[p], first_tie[p], host[p] = doc_id, tie, firsts[i - 1][0]  # the last is before the first
    of_part = lambda x, kind: F.get(F.array(*(F.lit(v) for v in x)).cast(f"array<{kind}>"), F.col("part"))
    is_first = (F.col("doc_id").eqNullSafe(of_part(first_id, "long"))
                & (F.col("tie") == of_part(first_tie, "long")))
    own = F.struct("part", F.lit(0).alias("guest"))
    sent = F.struct(of_part(host, "int").alias("part"), F.lit(1).alias("guest"))
    return (rows.withColumn("p", F.explode(F.when(is_first, F.array(own, sent)).otherwise(F.array(own))))
            .select("p.part", "p.guest", "doc_id", "tie", "text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs).repartition("part").sortWithinPartitions(
        "part", "guest", F.col("doc_id").desc_nulls_last(), "tie", "text")
    return rows.mapInArrow(_task, DDL)


def _task(batches):
    held = None                         # (part, guest, doc_id, text) that waits for its next one
    for b in batches:
        rows = list(zip(b.column("part").to_pylist(), b.column("guest").to_pylist(),
                        b.column("doc_id").to_pylist(), texts(b.column("text"))))
        lo = 0
        while lo < len(rows):           # blocks of a few MB
            hi, size = lo, 0
            while hi < len(rows) and size < 2 << 20:
                size += len(rows[hi][3])
                hi += 1
            yield _block(([held] if held else []) + rows[lo:hi])
            held, lo = rows[hi - 1], hi


def _block(rows: list[tuple]) -> pa.RecordBatch:
    parts, guests, ids, got = (list(x) for x in zip(*rows))
    pairs = [i for i in range(len(got) - 1) if parts[i] == parts[i + 1] and not guests[i]]
    own, nxt, edited = [], [], []
    for i in pairs:
        t, n = got[i].decode(), got[i + 1].decode()
        half = len(t) // 2
        own.append(len(t))
        edited.append((t[:len(t) - half] + n[:half]).encode())
    sketches = sketch(got)
    edits = sketch(edited)
    return batch_of(SCHEMA, [
        [ids[i] for i in pairs], own, [hashlib.sha256(e).hexdigest() for e in edited],
        [hexed(sketches[i]) for i in pairs], [hexed(e) for e in edits],
        [likeness(sketches[i], e) for i, e in zip(pairs, edits)],
        [likeness(sketches[i], sketches[i + 1]) for i in pairs]])
