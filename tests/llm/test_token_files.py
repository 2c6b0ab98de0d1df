"""Token files: exact round trips, and the tokenizer's own encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tableguard.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "  a", "a  b", "a \n b", "a   \n\n  b", "don't 's 're it's", "<|endoftext|> x<|endoftext|>", "日本語 テスト  ok", "x²½ Ⅷ9 a1b2",
       " a\xa0b", "a  b", "tab\t x \tz", "🙂 🙂🙂", " 's", "a 's\x1c b", "é é", "\x1c a \x1cb", "İ ǆ ß", "  \n  ", "a" * 70_000, "\x00 \x00", "ɐ ɏ. ɐɏ"]


def own(texts):
    t = Tokenizer.from_file(PATH)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


@pytest.mark.parametrize("ids", [[], [7], list(range(5000)), [2 ** 32 - 1] * 3000, [0, 2 ** 32 - 1] * 900, [9] * 1024 + [2 ** 31]])
@pytest.mark.parametrize("percentile", [1, 90, 100])
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    blocks = T.encode_blocks(ids, percentile)
    starts = np.cumsum([0, *map(len, blocks)])
    assert len(blocks) == -(-len(ids) // T.BLOCK)
    if len(ids):
        assert (T.decode_blocks(b"".join(blocks), starts)[:len(ids)] == ids).all()


def test_blocks_of_every_width_and_their_exceptions():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 1 << w, T.BLOCK, dtype=np.uint64).astype(np.uint32) for w in range(33) for _ in range(2)])
    ids[::97] = rng.integers(0, 1 << 32, len(ids[::97]), dtype=np.uint64)
    blocks = T.encode_blocks(ids)
    assert (T.decode_blocks(b"".join(blocks), np.cumsum([0, *map(len, blocks)])) == ids).all()
    # 90 % of small ids set the width; the others are exceptions
    few = np.zeros(T.BLOCK, np.uint32)
    few[:100] = 1 << 20
    assert len(T.encode_blocks(few)[0]) == 7 + 100 * (2 + 4)


def test_encoder_is_the_tokenizer(monkeypatch):
    rnd = random.Random(5)
    alphabet = ["a", "Éa", "z", " ", " ", "  ", "\n", "'s", "'", ".", "9", "½", "語", "\t", "\xa0", "_", "-", "<|endoftext|>", " ", "ſ"]
    texts = ODD + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 40))) for _ in range(600)]
    e, want = T.Encoder(PATH), own(texts)
    for forget in (T.KEPT, 3):
        monkeypatch.setattr(T, "KEPT", forget)
        for lo in range(0, len(texts), 50):
            ids, n = e.encode(pa.array(texts[lo:lo + 50]))
            ends = np.cumsum(n)
            for i, w in enumerate(want[lo:lo + 50]):
                assert ids[ends[i] - n[i]:ends[i]].tolist() == w, texts[lo + i]
    e.by_pieces = False
    ids, n = e.encode(pa.array(texts[:30]))
    assert ids.tolist() == [x for w in want[:30] for x in w] and n.tolist() == [len(w) for w in want[:30]]
    assert len(e.encode(pa.array([], pa.string()))[0]) == 0


def brute(rows):
    at, out = 0, []
    for i, ids in sorted(zip([r[0] for r in rows], own([r[1] for r in rows])), key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_files_against_brute_force(spark):
    from tableguard.llm.queries import QUERIES
    table = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows_of(QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001")) == brute(table)


def test_small_files_nulls_repeats_and_other_columns(spark):
    table = [(None, "no id"), (5, "five"), (9, ""), (-3, None), *((100 + i, x) for i, x in enumerate(ODD)), *((2000 + i, "same text") for i in range(40))]
    df = spark.createDataFrame([(i, x, 1, "y", 2) for i, x in table], "doc_id int, text string, start int, path string, n_ids int")
    files = T.write_tokens(df, PATH, file_ids=30)
    assert rows_of(T.read_tokens(files)) == brute(table)
    assert files.count() > 5 and files.where("n_docs > 1").count() > 0
    same = spark.createDataFrame([(7, "a b"), (7, "c d e"), (7, "a b"), (7, None)], "doc_id long, text string")
    a, b = (rows_of(T.read_tokens(T.write_tokens(x, PATH))) for x in (same, same.orderBy("text").repartition(3)))
    assert a == b and len(a) == 4
    assert T.read_tokens(T.write_tokens(df.limit(0), PATH)).count() == 0


def test_one_file_by_ranges(tmp_path):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50_257, 10_000).astype(np.uint32)
    w = T.Writer(f"file://{tmp_path}/x/a.bin")
    w.add(np.array([4, 0]), np.array([False, True]), np.array([9_000, 1_000]), ids)
    assert w.close()["n_ids"] == 10_000
    r = T.Reader(f"{tmp_path}/x/a.bin")
    for lo, hi in [(0, 10_000), (1023, 1025), (5, 5), (9_999, 10_000), (2_048, 3_072)]:
        assert (r.tokens(lo, hi) == ids[lo:hi]).all()
    assert r.doc_ids.tolist() == [4, 0] and r.nulls.tolist() == [False, True] and r.first.tolist() == [0, 9_000, 10_000]
    data = (tmp_path / "x/a.bin").read_bytes()
    (tmp_path / "x/b.bin").write_bytes(data[:-5])
    with pytest.raises(ValueError):
        T.Reader(f"{tmp_path}/x/b.bin")
    long = list(T._documents(r, 50, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]), most=700))
    assert [b.column("ids_crc32")[0].as_py() for b in long] == [zlib.crc32(ids[:9000].astype("<u4").tobytes()), zlib.crc32(ids[9000:].astype("<u4").tobytes())]
