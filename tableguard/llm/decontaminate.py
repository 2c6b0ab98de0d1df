"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Every window of ``window`` consecutive words of an item (an item of fewer words, but not none,
is one window) becomes a pattern ``" w1 w2 ... "``.  Each document is normalised once (A-Z
lower-cased, words joined by single spaces) and scanned once; a match's end is turned into word
numbers and from there into offsets of the original text.

The automaton lives in every worker, so its size is checked: items beyond ``max_block_bytes`` of
text are dealt by hash into several blocks with an automaton each, and the documents are scanned
once for each block.  Spark tasks write the patterns of each block into the shared folder, and a
worker reads a block once and keeps its automaton; the driver sees the blocks' file names only.
No document is shuffled.

Defined cases: a null or empty text has no words and no hits; an item without words matches
nothing; items that share an id count as one; an item with a null id marks words but is not
counted; repeated document rows are scanned one by one; other columns are ignored.
"""

from __future__ import annotations

import pickle
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import WORD, alnum_words, batch_of, checkpoint_root, materialize, text_key, texts
from .shared_arrays import load, save

WINDOW = 10
MAX_BLOCK_BYTES = 16 << 20
SCHEMA = pa.schema([("n_words", pa.int64()), ("words", pa.list_(pa.int64())),
                    ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))])


def patterns(items: list[tuple], window: int = WINDOW) -> dict[str, tuple[int, list[str]]]:
    """pattern -> (its number of words, the ids of its items)."""
    found: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = alnum_words((text or "").encode())
        for i in range(max(1, len(words) - window + 1) if words else 0):
            own = words[i:i + window]
            key = (b" " + b" ".join(own) + b" ").decode("latin-1")
            found.setdefault(key, (len(own), set()))[1].add(item_id)
    return {k: (n, sorted(str(x) for x in ids if x is not None)) for k, (n, ids) in found.items()}


def automaton(found: dict[str, tuple[int, list[str]]]):
    a = ahocorasick.Automaton()
    for key, value in found.items():
        a.add_word(key, value)
    if found:
        a.make_automaton()
    return a


def scan(text: bytes, a) -> tuple[int, list[int], list[str], list[list[int]]]:
    """Words of the text, the numbers of hit words, item ids, and hit spans [start, end) in
    code points of the original text."""
    flat = text.translate(WORD)
    words = flat.split()
    if not words or not len(a):
        return len(words), [], [], []
    norm = b" " + b" ".join(words) + b" "
    matches = list(a.iter(norm.decode("latin-1")))
    if not matches:
        return len(words), [], [], []
    blanks = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    edge, items = np.zeros(len(words) + 1, np.int64), set()
    for at, (end, (n, ids)) in zip(np.searchsorted(blanks, [e for e, _ in matches]).tolist(), matches):
        edge[at - n] += 1
        edge[at] -= 1
        items.update(ids)
    hit = np.cumsum(edge)[:-1] > 0
    inside = np.frombuffer(flat, np.uint8) != 32
    bounds = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    runs = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).reshape(-1, 2)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    spans = [[int(chars[bounds[2 * i]]), int(chars[bounds[2 * j - 1]])] for i, j in runs.tolist()]
    return len(words), np.flatnonzero(hit).tolist(), sorted(items), spans


def pattern_files(benchmark: DataFrame, window: int, max_block_bytes: int) -> list[str]:
    """The files of the blocks of items: each holds the patterns of a bounded amount of text."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length(text_key()) + 64)).first()[0] or 0
    n = max(1, -(-int(size) // max_block_bytes))
    folder = f"{checkpoint_root(benchmark.sparkSession)}/items-{uuid.uuid4().hex}"

    def task(batches):
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for block, item, text in zip(*(b.column(c).to_pylist() for c in ("block", "item_id", "text"))):
                held.setdefault(block, []).append((item, text))
        for block, own in held.items():
            data = pickle.dumps(patterns(own, window))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "file": [save(folder, np.frombuffer(data, np.uint8))]})

    rows = items.dropDuplicates().withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("long"))
    made = materialize(rows.repartition(n, "block").mapInArrow(task, "block long, file string"), "items")
    return [r.file for r in made.orderBy("block").collect()]


_kept: dict[str, object] = {}


def kept_automaton(path: str):
    """The automaton of a block's file, built once in each worker; the worker keeps its newest one."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = automaton(pickle.loads(load(path, np.uint8).tobytes()))
    return _kept[path]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` plus n_words, words (numbers of the hit words), items (ids as
    sorted strings) and spans ([start, end) of hit passages, in code points)."""
    files = pattern_files(benchmark, window, max_block_bytes) or [None]      # None: no items
    kept = [f for f in docs.schema.fields if f.name not in SCHEMA.names]
    docs = docs.select([f.name for f in kept])

    def scanned(rows: DataFrame, file: str | None, first: bool) -> DataFrame:
        def task(batches):
            a = kept_automaton(file) if file else automaton({})
            for b in batches:
                got = [scan(t, a) for t in texts(b.column("text"))]
                new = batch_of(SCHEMA, [list(x) for x in zip(*got)] if got else [[]] * len(SCHEMA))
                if not first:   # joined with what the earlier blocks have found
                    old = b.select(SCHEMA.names).to_pylist()
                    new = batch_of(SCHEMA, [list(x) for x in zip(*(merged(o, n) for o, n in zip(old, new.to_pylist())))]
                                   if old else [[]] * len(SCHEMA))
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), *new.columns],
                                                 names=[*(f.name for f in kept), *SCHEMA.names])

        ddl = "n_words long, words array<long>, items array<string>, spans array<array<long>>"
        return rows.mapInArrow(task, StructType([*kept, *StructType.fromDDL(ddl).fields]))

    out = docs
    for k, file in enumerate(files):
        out = scanned(out, file, k == 0)
    return out


def merged(a: dict, b: dict) -> tuple:
    spans = sorted([*a["spans"], *b["spans"]])
    joined: list[list[int]] = []
    for s, e in spans:
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    return (a["n_words"], sorted({*a["words"], *b["words"]}), sorted({*a["items"], *b["items"]}), joined)


def digest(rows: DataFrame) -> DataFrame:
    """One row per document: counts and a digest of the item ids."""
    return rows.select(
        "doc_id", "n_words", F.size("words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("words") > 0).alias("contaminated"))
