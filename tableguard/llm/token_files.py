"""Token files: documents as token ids in patched frame-of-reference blocks.

A file holds blocks of 1024 ids.  Each block stores its smallest id, the differences to it packed at the width
that ``PERCENTILE`` of them need, and an exception list (place, high bits) of those that need more.  Packed
words lie in 32 lanes (id ``32 i + j`` is value i of lane j), so a block is packed and read with 32 shifts of
whole rows.  Behind the blocks stand the index of block starts and the documents' table (id, first token), so
any range of tokens is read from its own blocks; a footer closes the file.

Plan.  Documents are range-partitioned and sorted by (doc_id, text hash, number), texts are shuffled once, and
each task writes its range as files of about ``file_ids`` ids in the shared folder, under names of its own; only
the names in the results of successful tasks count, so a task that runs again does no harm.  A file's place in
the whole is the running total of the ids before it: over the files of a task, and over one row for each task.

Encoding.  For byte-level BPE without normalisation a text may be cut before any space that a word follows, as
no pre-token spans such a place; the pieces of a batch are told apart by Arrow, each distinct piece is encoded
once by the tokenizer's own model, and a worker keeps the pieces it has met (up to ``KEPT``; then it starts
anew).  Texts with a space before other white space are cut by the same rule one by one; texts that hold an
added token, and all texts of other kinds of tokenizer, go through the tokenizer whole.

Defined cases: a null text is empty and has the end id only; null doc_ids come first; rows of one doc_id are
ordered by a hash of their text; an empty table gives no file and no row; texts are encoded whole, of any
length; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import batch_of, checkpoint_root, materialize, text_key

BLOCK, LANES = 1024, 32
PERCENTILE = 90                 # share of a block's values that the packed width holds
FILE_IDS = 1 << 26              # a file is closed at the document that passes this
READERS = 10_000                # most tasks that read files at a time
KEPT = 1 << 21                  # pieces a worker keeps
MAGIC = b"TGPFOR1\n"
END_ID = 2


# -- blocks --------------------------------------------------------------------------------
def _bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 1024) values below 2**width -> (blocks, width, 32) words."""
    rows = values.reshape(-1, BLOCK // LANES, LANES)
    out = np.zeros((len(rows), width, LANES), np.uint32)
    for i in range(BLOCK // LANES if width else 0):
        word, at = divmod(i * width, 32)
        out[:, word] |= rows[:, i] << np.uint32(at)
        if at + width > 32:
            out[:, word + 1] |= rows[:, i] >> np.uint32(32 - at)
    return out


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK // LANES, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(BLOCK // LANES if width else 0):
        word, at = divmod(i * width, 32)
        out[:, i] = words[:, word] >> np.uint32(at)
        if at + width > 32:
            out[:, i] |= words[:, word + 1] << np.uint32(32 - at)
        out[:, i] &= mask
    return out.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Blocks of uint32 ids; the last one is filled up with its smallest id."""
    if not len(ids):
        return []
    fill = -len(ids) % BLOCK
    ids = np.concatenate([ids, np.full(fill, ids[len(ids) + fill - BLOCK:].min(), np.uint32)]).reshape(-1, BLOCK)
    return [x for lo in range(0, len(ids), 256) for x in _encoded(ids[lo:lo + 256], percentile)]


def _encoded(ids: np.ndarray, percentile: int) -> list[bytes]:
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    k = -(-percentile * BLOCK // 100) - 1
    width = _bit_lengths(np.partition(rest, k, axis=1)[:, k])
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        mine = rest[at]
        words = pack(mine & np.uint32((1 << w) - 1), w)
        over = mine > np.uint32((1 << w) - 1)
        rows, places = np.nonzero(over)
        ends = np.searchsorted(rows, np.arange(len(at) + 1))
        high = (mine[over] >> np.uint32(w)).astype("<u4") if w < 32 else np.zeros(0, "<u4")
        for j, b in enumerate(at.tolist()):
            lo, hi = ends[j], ends[j + 1]
            out[b] = b"".join((int(low[b]).to_bytes(4, "little"), int(w).to_bytes(1, "little"), int(hi - lo).to_bytes(2, "little"),
                               words[j].astype("<u4").tobytes(), places[lo:hi].astype("<u2").tobytes(), high[lo:hi].tobytes()))
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at starts[:-1] in the data."""
    n = len(starts) - 1
    raw = np.frombuffer(data, np.uint8)
    head = raw[starts[:-1, None] + np.arange(7)]
    low = head[:, :4].copy().view("<u4")[:, 0]
    width, count = head[:, 4].astype(np.int64), head[:, 5:7].copy().view("<u2")[:, 0].astype(np.int64)
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        size = 4 * w * LANES
        for part in np.array_split(at, -(-len(at) // 4096)) if w else ():
            words = raw[starts[part, None] + 7 + np.arange(size)].view("<u4").reshape(-1, w, LANES)
            out[part] = unpack(words, w)
    for b in np.flatnonzero(count).tolist():
        c, w = int(count[b]), int(width[b])
        at = int(starts[b]) + 7 + 4 * w * LANES
        places = np.frombuffer(data, "<u2", c, at)
        out[b, places] |= np.frombuffer(data, "<u4", c, at + 2 * c) << np.uint32(w)
    return (out + low[:, None]).ravel()


# -- files ---------------------------------------------------------------------------------
def _store(path: str):
    """(file system, its path); a local one for plain paths and file URLs.  Hadoop's names of S3 are S3."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return fs.LocalFileSystem(), url.path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


class Writer:
    """One file of documents' ids, written block by block."""

    def __init__(self, path: str, percentile: int = PERCENTILE):
        self.path, self.percentile = path, percentile
        store, name = _store(path)
        store.create_dir(os.path.dirname(name), recursive=True)
        self.out = store.open_output_stream(name)
        self.out.write(MAGIC)
        self.at, self.starts, self.open = len(MAGIC), [], np.zeros(0, np.uint32)
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.n_ids = self.n_docs = 0

    def _blocks(self, ids: np.ndarray) -> None:
        blocks = encode_blocks(ids, self.percentile)
        for b in blocks:
            self.starts.append(self.at)
            self.at += len(b)
        self.out.write(b"".join(blocks))

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids.astype("<i8"))
        self.nulls.append(nulls.astype(np.uint8))
        self.lengths.append(lengths.astype("<i8"))
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        ids = np.concatenate([self.open, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.open = ids[whole:]

    def close(self) -> dict:
        self._blocks(self.open)
        lengths = np.concatenate([np.zeros(1, "<i8"), *self.lengths])
        tail = [np.array([*self.starts, self.at], "<u8"), np.cumsum(lengths).astype("<u8"), np.concatenate([np.zeros(0, "<i8"), *self.docs]),
                np.concatenate([np.zeros(0, np.uint8), *self.nulls])]
        data = b"".join(x.tobytes() for x in tail)
        footer = np.array([self.n_ids, self.n_docs, len(self.starts), self.at, zlib.crc32(data)], "<u8")
        self.out.write(data + footer.tobytes() + MAGIC)
        self.out.close()
        return {"path": self.path, "n_ids": self.n_ids, "n_docs": self.n_docs}


class Reader:
    """Random access to a file: only the blocks of the wanted tokens are read."""

    def __init__(self, path: str):
        store, name = _store(path)
        self.file = store.open_input_file(name)
        size, f = self.file.size(), 8 * 5 + len(MAGIC)
        footer = self.file.read_at(f, size - f)
        if footer[-len(MAGIC):] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.n_ids, self.n_docs, blocks, at, crc = np.frombuffer(footer, "<u8", 5).astype(np.int64).tolist()
        data = self.file.read_at(size - f - at, at)
        if zlib.crc32(data) != crc:
            raise ValueError(f"{path}: the index does not match its checksum")
        self.starts = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        self.first = np.frombuffer(data, "<u8", self.n_docs + 1, 8 * (blocks + 1)).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, 8 * (blocks + self.n_docs + 2))
        self.nulls = np.frombuffer(data, np.uint8, self.n_docs, 8 * (blocks + 2 * self.n_docs + 2)).astype(bool)

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo ... hi - 1 of the file."""
        a, b = lo // BLOCK, -(-hi // BLOCK)
        if hi <= lo:
            return np.zeros(0, np.uint32)
        at = self.starts[a:b + 1]
        data = self.file.read_at(int(at[-1] - at[0]), int(at[0]))
        return decode_blocks(data, at - at[0])[lo - a * BLOCK:hi - a * BLOCK]


# -- encoding ------------------------------------------------------------------------------
# The pre-tokens of byte-level BPE, and the characters that stand for bytes.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = dict(zip(_PRINTED, map(chr, _PRINTED))) | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}
_LATIN = "ɐ"       # below it the classes of characters are the same in every version of Unicode


class Encoder:
    """Texts to ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        pre = form["pre_tokenizer"] or {}
        self.model = self.tokenizer.model
        self.added = [x["content"] for x in form["added_tokens"]]
        self.by_pieces = (form["normalizer"] is None and form["truncation"] is None and form["padding"] is None
                          and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                          and form["model"]["type"] == "BPE" and not form["model"]["dropout"])
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, bytes] = {}
        self.known = pa.array([], pa.large_string())
        self.unsafe = np.zeros(0, bool)
        self.length = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def _word(self, word: str) -> bytes:
        """The ids of a pre-token, as bytes."""
        ids = self.words.get(word)
        if ids is None:
            chars = word.encode().decode("latin-1").translate(BYTE_CHARS)
            ids = self.words[word] = array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()
        return ids

    def _new(self, pieces: pa.Array) -> list[bytes]:
        """The ids of pieces that stand behind a space."""
        high = pc.match_substring_regex(pieces, rf"[^\x{{1}}-\x{{{ord(_LATIN) - 1:x}}}]").to_pylist()
        plain = pc.utf8_is_alpha(pieces).to_pylist()
        words, word, find, out = self.words, self._word, self.pre_tokens.findall, []
        for s, h, letters in zip(pieces.to_pylist(), high, plain):
            s = " " + s
            if h:
                out.append(self._piece(s))
            elif letters:
                out.append(words.get(s) or word(s))
            else:
                out.append(b"".join([words.get(w) or word(w) for w in find(s)]))
        return out

    def _piece(self, piece: str) -> bytes:
        """The ids of a text, or of a piece of one that begins at a space."""
        if not piece:
            return b""
        if max(piece) >= _LATIN:
            return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, np.uint32).tobytes()
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
            return self._word(piece)
        return b"".join(map(self._word, self.pre_tokens.findall(piece)))

    def _text(self, text: str) -> bytes:
        """A text that cannot be cut at every space."""
        if any(x in text for x in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        pieces: list[str] = []
        for i, p in enumerate(text.split(" ")):
            if not i:
                pieces.append(p)
            elif p and not p[0].isspace():
                pieces.append(" " + p)
            else:
                pieces[-1] += " " + p
        return b"".join(map(self._piece, pieces))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """The number of each distinct piece; new ones are encoded."""
        if len(self.known) > KEPT:
            self._forget()
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        out = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        if len(new):
            ids = self._new(new)
            out[out < 0] = len(self.known) + np.arange(len(new), dtype=np.int32)
            self.unsafe = np.concatenate([self.unsafe, np.array([not s or s[0].isspace() for s in pc.utf8_slice_codeunits(new, 0, 1).to_pylist()])])
            self.length = np.concatenate([self.length, np.array(list(map(len, ids)), np.int32) // 4])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), np.uint32)])
            self.known = pa.concat_arrays([self.known, new])
        return out

    def encode(self, texts: pa.Array, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by the end id; number of ids of each text)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.by_pieces:
            found = [np.array([*x.ids, end], np.uint32) for x in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate(found), np.array([len(x) for x in found], np.int64)
        parts = pc.split_pattern(texts, " ")
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(count) - count
        coded = parts.flatten().dictionary_encode()
        place = self._places(coded.dictionary)
        unit = place[coded.indices.to_numpy(zero_copy_only=False)]
        odd = self.unsafe[unit]
        odd[first] = False
        whole = np.zeros(n, bool)
        whole[np.searchsorted(first, np.flatnonzero(odd), "right") - 1] = True
        for x in self.added:
            whole |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        heads = pc.list_element(parts, 0).to_pylist()
        own = [self._text(texts[i].as_py()) if w else self._piece(heads[i]) for i, w in enumerate(whole.tolist())]
        # units: the worker's pieces, then each text's own head, then nothing, then the end id
        size = np.concatenate([self.length, np.array([len(x) // 4 for x in own], np.int32), np.array([0, 1], np.int32)])
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(own), np.uint32), np.array([end], np.uint32)])
        start = (np.cumsum(size) - size).astype(np.int32)
        nothing = len(size) - 2
        for i in np.flatnonzero(whole).tolist():
            unit[first[i]:first[i] + count[i]] = nothing
        unit[first] = len(self.length) + np.arange(n)
        unit = np.insert(unit, first + count, nothing + 1)
        start, size = start[unit], size[unit]
        behind = np.cumsum(size, dtype=np.int64)
        lengths = np.diff(behind[np.cumsum(count + 1) - 1], prepend=0)
        take = np.ones(behind[-1], np.int32)        # steps of one within a unit, a jump at each next one
        some = size > 0
        start, size, behind = start[some], size[some], behind[some]
        take[0] = start[0]
        take[behind[:-1]] = start[1:] - (start[:-1] + size[:-1] - 1)
        np.cumsum(take, out=take)
        return flat[take], lengths


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- Spark ---------------------------------------------------------------------------------
def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END_ID, file_ids: int = FILE_IDS,
                 percentile: int = PERCENTILE) -> DataFrame:
    """Write the documents' ids in ascending order of doc_id; (path, n_ids, n_docs, start) of each file, where
    start is the number of ids before it."""
    folder = folder or f"{checkpoint_root(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "id": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), "h", "id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())])

    def task(batches):
        part, number, out = TaskContext.get().partitionId(), 0, None
        made = []
        for b in batches:
            for lo in range(0, b.num_rows, 1 << 13):
                cut = b.slice(lo, 1 << 13)
                ids, lengths = encoder(tokenizer).encode(cut.column("text"), end)
                nulls = cut.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                doc_ids = cut.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                last = np.cumsum(lengths)
                a = 0
                while a < len(lengths):
                    out = out or Writer(f"{folder}/part-{part:05d}-{number:05d}-{uuid.uuid4().hex}.bin", percentile)
                    done = last[a - 1] if a else 0
                    z = min(len(lengths), int(np.searchsorted(last, done + file_ids - out.n_ids)) + 1)
                    out.add(doc_ids[a:z], nulls[a:z], lengths[a:z], ids[done:last[z - 1]])
                    a = z
                    if out.n_ids >= file_ids:
                        made.append((number, out.close()))
                        number, out = number + 1, None
        if out:
            made.append((number, out.close()))
        if made:
            yield batch_of(schema, [[part] * len(made), [i for i, _ in made], *([x[k] for _, x in made] for k in ("path", "n_ids", "n_docs"))])

    files = materialize(rows.mapInArrow(task, "part int, number int, path string, n_ids long, n_docs long"), "token-files")
    within = Window.partitionBy("part").orderBy("number")
    # one row for each task that wrote: bounded by the number of partitions
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    return (files.join(parts, "part").withColumn("start", F.col("before") + F.sum("n_ids").over(within) - F.col("n_ids"))
            .select("path", "n_ids", "n_docs", "start"))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def task(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                yield from _documents(Reader(path), start, schema)

    spread = min(READERS, max(1, files.count()))
    return files.repartition(spread).mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(file: Reader, start: int, schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A file's documents, read in runs of about ``most`` ids; a longer one is read piece by piece."""
    lo = 0
    while lo < file.n_docs:
        hi = max(lo + 1, int(np.searchsorted(file.first, file.first[lo] + most, "right")) - 1)
        at = file.first[lo:hi + 1]
        if at[-1] - at[0] <= most:
            data = file.tokens(int(at[0]), int(at[-1])).astype("<u4").tobytes()
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist())]
        else:
            crc = [0]
            for a in range(int(at[0]), int(at[-1]), most):
                crc[0] = zlib.crc32(file.tokens(a, min(a + most, int(at[-1]))).astype("<u4").tobytes(), crc[0])
        yield batch_of(schema, [pa.array(file.doc_ids[lo:hi], mask=file.nulls[lo:hi]), pa.array(at[:-1] + start),
                                pa.array(np.diff(at)), crc])
        lo = hi

