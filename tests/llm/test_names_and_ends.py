"""User columns of any name pass untouched; the similarity join ends where leaders find nothing."""

import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from tableguard.llm import line_dedup, mixing, ngram_join
from tableguard.llm.queries import QUERIES

NAMES = ["repeated", "marks", "mark_key", "rep_key", "row_key", "class", "chunk", "keeper", "pos", "h", "n", "made", "offset", "run_no", "run",
         "before", "place", "run_source", "name", "weight", "cap", "level", "stay", "score", "predicted", "words", "items", "n_words",
         "k", "x", "t", "component_id", "a.b", "back`tick", "_user_0"]


def named(df, extra=()):
    return df.select("*", *(F.lit(f"user {n}").alias(n) for n in [*NAMES, *extra]))


def untouched(df, extra=()):
    rows = df.collect()
    for n in [*NAMES, *extra]:
        assert df.columns.count(n) == 1 and {r[n] for r in rows} <= {f"user {n}"}, n
    return rows


def test_operators(spark):
    docs = spark.createDataFrame([(i, f"l{i % 7}\nl{i % 5}\nx", f"s{i % 3}") for i in range(40)] + [(None, None, None), (3, "", "s1")],
                                 "doc_id long, text string, source string")
    for passages in (False, True):
        got = untouched(line_dedup.line_dedup(named(docs, ["size"]), passages=passages), ["size"])
        plain = line_dedup.line_dedup(docs, passages=passages).collect()
        key = lambda r: (str(r.doc_id), r.text or "", r.removed_lines, r.n_lines)
        assert sorted(map(key, got)) == sorted(map(key, plain))
    got, plain = untouched(mixing.schedule(named(docs))), mixing.schedule(docs).collect()
    key = lambda r: (str(r.doc_id), r.size, r.start, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, plain)) and sum(r.taken for r in got) > 0
    for made in ("taken", "removed_lines"):
        mine = docs.withColumn(made, F.lit("user's"))
        op = mixing.schedule if made == "taken" else line_dedup.line_dedup
        assert op(mine).columns.count(made) == 1 and op(mine).where(f"{made} = 0").count() > 0


def test_pipeline_stages(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 60")
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "src1", 0)], docs.schema)
    docs = docs.unionByName(odd)
    for name, stage in P.STAGES:
        plain, got = stage(spark, docs, str(tmp_path)), stage(spark, named(docs), str(tmp_path))
        assert sorted(str(r.doc_id) for r in untouched(got)) == sorted(str(r.doc_id) for r in plain.collect()), name
        empty = stage(spark, named(docs).limit(0), str(tmp_path))
        assert empty.count() == 0 and set(NAMES) <= set(empty.columns)


def test_near_groups_end_where_leaders_find_nothing(spark):
    """Groups of copies of sizes that cannot be similar, tied together by one phrase that all of them hold."""
    rng, rows = np.random.default_rng(7), []
    for k in range(24):
        text = " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, int(26 * 1.3 ** k)))
        rows += [(31 * k + i, text) for i in range(30)] + [(31 * k + 30, "one phrase behind five words " + text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    began = time.time()
    for long in (None, ngram_join.LONG):
        got = ngram_join.near_groups(docs, long=long).collect()
        assert all(r.component_id == r.doc_id // 31 * 31 for r in got)
    assert time.time() - began < 240


def test_new_queries_ignore_other_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    made = ["doc_id", "text", "lang", "source"]
    named(docs.select(*made), ["start", "path", "term", "total", "block", "rank", "value"]).write.parquet(f"{tmp_path}/documents.parquet")
    docs.select(*made).write.parquet(f"{tmp_path}/plain/documents.parquet")
    for q in ("op12_token_files", "op13_source_divergence"):
        a, b = (sorted(map(tuple, QUERIES[q](spark, str(p)).collect())) for p in (tmp_path, tmp_path / "plain"))
        assert a == b
