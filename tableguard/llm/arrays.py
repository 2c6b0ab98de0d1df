"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Byte tables.  Text is UTF-8, so every byte of a non-ASCII character is >= 0x80 and
# byte-wise rules for ASCII are exact.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A-Z lower-cased; everything in \x00-\x2F, \x3A-\x60, \x7B-\x7F (after lower-casing) a space.
WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER)


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.translate(WORD).split()


def text_key() -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def aside(df: DataFrame, inputs, made=()) -> tuple[DataFrame, dict[str, str]]:
    """(df with all columns but ``inputs`` under names that no operator uses, {its name there: user's name}).
    User columns that are named like one an operator makes (``made``) are left out."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    names = {f"_user_{i}": c for i, c in enumerate(df.columns) if c not in inputs and c not in made}
    return df.select(*(quoted(c) for c in df.columns if c in inputs), *(quoted(c).alias(n) for n, c in names.items())), names


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.
    Where it is unset, a local session gets a folder of its own; a cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return root


#: Spark's own setting: a statement's shuffle files go when it ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, and a lost
    executor costs its running tasks only.  What the write shuffled is removed as soon as it has ended."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def pieces(off: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; one row may be longer."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def texts(col: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row, one at a time."""
    data, off = utf8(col)
    buf = data.tobytes()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield buf[a:b]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


# -- 64-bit hashing of byte runs (numpy, modulo 2**64) -----------------------------------
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n; kept in blocks that double, so long texts cost memory once."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n + 1]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] the positional hash of codes[i:j]."""
    h = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(_BASE, len(codes))[:len(codes)], out=h[1:])
    return h


def run_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end), the same wherever the run stands."""
    inv = powers(_BASE_INV, len(h))
    return mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64))


def space_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and the row of each."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = np.frombuffer(LOWER, np.uint8)[data]
    inside = (low != 32) & ((low < 9) | (low > 13))
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    first = off[:-1][off[:-1] < len(data)]
    before[first] = False                      # a word never crosses a row's start
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:] & before[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return (run_hash(prefix_hash(BYTE_CODES[low]), starts, ends),
            np.searchsorted(off, starts, "right") - 1)
