"""Suffix-array dedup: every repeat of at least ``length`` bytes, with all of its occurrences.

A global suffix array has a suffix for each byte and compares neighbours only.  Here it is cut into
independent pieces that Spark can shuffle.  Every ``length``-byte string has an anchor: the place of
its smallest 48-byte gram hash (leftmost on ties).  Equal strings have equal anchors at equal places,
so every repeat shows up among the anchors of one hash.  An anchor's context is the text under all the
windows it is the anchor of, on average 275 bytes for 75 bytes of text.

1. Anchors (hash h, hash g of the context, text, place) are computed from the texts; hashes that
   stand once in the corpus are dropped.
2. Equal contexts (h, g) are counted.  A context that stands twice is a repeat as a whole, and one of
   them speaks for all from here on: a hot passage is one row.
3. Hashes with several different contexts are resolved on the bytes: the suffixes that begin at the
   anchor are sorted into an enhanced suffix array (order and common-prefix lengths); a stack scan
   yields the common-prefix interval tree; in each interval the texts to the left of the anchor are
   tested for left-extension diversity by the same scan over their reversed order.  An interval pair
   of common suffix ``left`` and common prefix ``right`` that is diverse on both sides is a maximal
   repeat group with all of its members.
4. A hash with more than ``MAX_BUCKET`` different contexts is not gathered: each window of those
   contexts is counted by a 128-bit hash instead, which gives the same coverage.

Equal texts are one text with a count; of a text that stands twice everything is a repeat.

Defined cases: a null or empty text has no bytes; texts shorter than ``length`` have no repeats;
rows that repeat in doc_id or text are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_CODES, batch_of, materialize, mix, pieces, prefix_hash, run_hash, text_key, texts, utf8

LENGTH, GRAM = 200, 48
MAX_BUCKET = 2000
_ANCHORS = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("c", pa.binary()), ("p", pa.int64())])
_SPANS = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("left", pa.int32()), ("right", pa.int32()),
                    ("repeat", pa.int64())])
_DONE = pa.schema([("c", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("kept_sha256", pa.string())])


# -- anchors -----------------------------------------------------------------------------
def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, place, first window, last window, h, g) of every anchor; places count from the row's start.
    ``length - gram`` must be below 256."""
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off[:-1], off[1:]) if b - a >= length]
                            or [np.zeros(0, np.int64)])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    prefix = prefix_hash(BYTE_CODES[data])
    at = np.arange(len(data) - gram + 1)
    h = run_hash(prefix, at, at + gram)
    # high half: the hash; low half: the place, so that the smallest is the leftmost of ties
    low = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    place = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(off, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place, row, a, b = place[first], row[first], starts[first], starts[last]
    g = mix(run_hash(prefix, a, b + length) + (place - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = off[row]
    return row, place - base, a - base, b - base, h[place], g


def packed(place, first, last):
    """An anchor's place and how far before it its first and last window begin."""
    return place << 16 | (place - first) << 8 | (place - last)


def _anchor_task(length: int):
    def task(batches):
        seen: set[bytes] = set()                    # a text that repeats within a task is done once
        for b in batches:
            data, off = utf8(b.column("text"))
            keys = b.column("c").to_pylist()
            for lo, hi in pieces(off, 1 << 18):
                rows = [i for i in range(lo, hi) if keys[i] not in seen and not seen.add(keys[i])]
                if not rows:
                    continue
                own = np.concatenate([data[off[i]:off[i + 1]] for i in rows])
                at = np.concatenate(([0], np.cumsum([off[i + 1] - off[i] for i in rows])))
                row, place, first, last, h, g = anchors(own, at, length)
                key = pa.array([keys[i] for i in rows], pa.binary()).take(pa.array(row))
                yield batch_of(_ANCHORS, [pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), key,
                                          pa.array(packed(place, first, last))])
    return task


# -- one hash: the interval tree -----------------------------------------------------------
def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(value, first, last) of each interval of the sorted suffixes first..last whose common prefix is
    ``value``; lcp[i] stands between suffixes i and i + 1.  Inner intervals come first."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        begin = i
        while stack and stack[-1][0] > value:
            top, begin = stack.pop()
            yield top, begin, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def repeat_groups(left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): the maximal repeats of at least ``length`` bytes around the anchor.
    left: the texts before the anchor, reversed; right: from the anchor on.  Members are numbers of
    contexts; each group is diverse to the left and to the right, or ends where a context ends."""
    order = sorted(range(len(right)), key=right.__getitem__)
    lcp = [shared_prefix(right[i], right[j]) for i, j in zip(order, order[1:])]
    for r, a, b in intervals(lcp):
        need = length - r
        if need > max(len(left[i]) for i in order[a:b + 1]):
            continue
        # sorted by what stands before the anchor; rank: which child of the interval it is from
        child, of = 0, {order[a]: 0}
        for k in range(a, b):
            child += lcp[k] == r
            of[order[k + 1]] = child
        own = sorted(order[a:b + 1], key=left.__getitem__)
        before = [shared_prefix(left[i], left[j]) for i, j in zip(own, own[1:])]
        for n, x, y in intervals(before):
            members = own[x:y + 1]
            if n >= need and len({of[i] for i in members}) > 1:
                yield n, r, members


def _bucket_task(length: int, groups: bool):
    def resolve(rows: list[tuple]) -> list[tuple]:
        left, right = [r[2][::-1] for r in rows], [r[3] for r in rows]
        found, reach = [], {}
        for n, r, members in repeat_groups(left, right, length):
            if not groups:                          # all of them hold the anchor: their union is one span
                for i in members:
                    x, y = reach.get(i, (0, 0))
                    reach[i] = max(x, n), max(y, r)
                continue
            text = left[members[0]][:n][::-1] + right[members[0]][:r]
            name = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)
            found += [(rows[i][0], rows[i][1], n, r, name) for i in members]
        return found + [(rows[i][0], rows[i][1], n, r, None) for i, (n, r) in reach.items()]

    def task(batches):
        group: list[tuple] = []
        for b in batches:
            found: list[tuple] = []
            for row in zip(*(b.column(c).to_pylist() for c in ("h", "g", "left", "right"))):
                if group and group[-1][0] != row[0]:
                    found += resolve(group)
                    group = []
                group.append(row)
            yield batch_of(_SPANS, [list(x) for x in zip(*found)] or [[]] * 5)
        yield batch_of(_SPANS, [list(x) for x in zip(*resolve(group))] or [[]] * 5)
    return task


# -- jobs ----------------------------------------------------------------------------------
def content(docs: DataFrame) -> DataFrame:
    """(c, text): the text and its 128-bit key."""
    return docs.select(text_key().alias("text")).select(F.unhex(F.md5("text")).alias("c"), "text")


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(h, g, c, p) of all anchors whose hash stands more than once, written out.  A text that stands in
    several tasks is there several times; what follows asks for different places, not for rows."""
    all_rows = content(docs).mapInArrow(_anchor_task(length), "h long, g long, c binary, p long")
    place = F.xxhash64("c", "p")                    # tells the places of a hash apart
    often = (all_rows.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b"))
             .where("a <> b").select("h"))
    often = materialize(often, "hashes")
    return materialize(all_rows.join(often, "h", "left_semi"), "anchors")


def contexts(docs: DataFrame, wanted: DataFrame, length: int, windows: bool) -> DataFrame:
    """The texts of the wanted contexts (c, p, h, g): (h, g, left, right), or on demand a 128-bit hash
    (w1, w2) of each of their windows with ``left``, the bytes before the anchor."""
    lists = wanted.groupBy("c").agg(F.collect_list(F.struct("p", "h", "g")).alias("at"))
    rows = (content(docs).groupBy("c").agg(F.first("text").alias("text")).join(lists, "c"))
    schema = pa.schema([("h", pa.int64()), ("g", pa.int64())] + (
        [("w1", pa.int64()), ("w2", pa.int64()), ("left", pa.int32())] if windows
        else [("left", pa.binary()), ("right", pa.binary())]))

    def task(batches):
        for b in batches:
            for t, at in zip(texts(b.column("text")), b.column("at").to_pylist()):
                made: list[tuple] = []
                for x in at:
                    place, a, z = x["p"] >> 16, x["p"] >> 8 & 255, x["p"] & 255
                    if not windows:
                        made.append((x["h"], x["g"], t[place - a:place], t[place:place - z + length]))
                        continue
                    for before in range(z, a + 1):
                        d = hashlib.blake2b(t[place - before:place - before + length], digest_size=16).digest()
                        made.append((x["h"], x["g"], int.from_bytes(d[:8], "big", signed=True),
                                     int.from_bytes(d[8:], "big", signed=True), before))
                yield batch_of(schema, [list(v) for v in zip(*made)] or [[]] * len(schema))

    ddl = "h long, g long, " + ("w1 long, w2 long, left int" if windows else "left binary, right binary")
    return rows.select("text", "at").mapInArrow(task, ddl)


def spans(docs: DataFrame, rows: DataFrame, length: int, max_bucket: int, groups: bool) -> DataFrame:
    """(h, g, left, right, repeat): how far a repeat reaches before and after the anchor, for every
    different context that holds one.  groups: a row for each maximal repeat, named by ``repeat``; else
    one row for the union of a context's repeats."""
    place = F.xxhash64("c", "p")
    kinds = rows.groupBy("h", "g").agg((F.min(place) != F.max(place)).alias("twice"),
                                       F.min(F.struct("c", "p")).alias("at"))
    kinds = materialize(kinds.select("h", "g", "twice", "at.c", "at.p"), "contexts")
    several = kinds.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    several = kinds.join(several, "h").select("c", "p", "h", "g", "m")
    whole = kinds.where("twice").select(
        "h", "g", F.shiftright("p", 8).bitwiseAND(255).cast("int").alias("left"),
        (F.lit(length) - F.col("p").bitwiseAND(255)).cast("int").alias("right"), F.col("g").alias("repeat"))
    found = (contexts(docs, several.where(F.col("m") <= max_bucket), length, False)
             .repartition("h").sortWithinPartitions("h", "g")
             .mapInArrow(_bucket_task(length, groups), "h long, g long, left int, right int, repeat long"))
    hot = several.where(F.col("m") > max_bucket)
    if hot.limit(1).count():
        each = materialize(contexts(docs, hot, length, True), "windows")
        again = each.groupBy("w1", "w2").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a <> b")
        found = found.unionByName(each.join(materialize(again, "again"), ["w1", "w2"]).select(
            "h", "g", "left", (F.lit(length) - F.col("left")).alias("right"), F.col("w1").alias("repeat")))
    found = found.unionByName(whole)
    if not groups:
        found = found.groupBy("h", "g").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    return materialize(found, "repeats")


def occurrences(docs: DataFrame, length: int = LENGTH, max_bucket: int = MAX_BUCKET,
                groups: bool = True) -> DataFrame:
    """Every repeat with all occurrences between different places of different texts: (repeat, c, start,
    end), in bytes; ``c`` is the 16-byte md5 of the text.  Without ``groups``: (c, start, end) of what
    repeats cover around each anchor."""
    rows = anchor_rows(docs, length)
    place = F.shiftright("p", 16)
    return (rows.join(spans(docs, rows, length, max_bucket, groups), ["h", "g"])
            .select(*["repeat"] * groups, "c", (place - F.col("left")).alias("start"),
                    (place + F.col("right")).alias("end")))


def without(text: bytes, own: list[dict] | None, all_of_it: bool) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, what is left)."""
    if all_of_it:
        return len(text), 1, b""
    kept, at, runs = [], 0, 0
    for s, e in sorted((x["start"], x["end"]) for x in own or ()):
        if s > at or not runs:
            kept.append(text[at:s])
            runs += 1
        at = max(at, e)
    kept.append(text[at:])
    left = b"".join(kept)
    return len(text) - len(left), runs, left


def remove_repeats(docs: DataFrame, length: int = LENGTH, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: what stays of each document without any byte
    that a repeated ``length``-byte string covers."""
    found = occurrences(docs, length, max_bucket, groups=False)
    lists = found.groupBy("c").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    distinct = content(docs).groupBy("c").agg(F.first("text").alias("text"), F.count("*").alias("n"))

    def task(batches):
        for b in batches:
            made = []
            for t, n, own in zip(texts(b.column("text")), b.column("n").to_pylist(), b.column("spans").to_pylist()):
                gone, runs, left = without(t, own, n > 1 and len(t) >= length)
                made.append((len(t), gone, runs, hashlib.sha256(left).hexdigest()))
            yield batch_of(_DONE, [b.column("c"), *([list(v) for v in zip(*made)] or [[]] * 4)])

    done = (distinct.join(lists, "c", "left")
            .mapInArrow(task, "c binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    ids = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(text_key())).alias("c"))
    return ids.join(done, "c").drop("c")
