"""The registered queries: SQL parity where there is SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tableguard.llm import decontaminate, ngram_join
from tableguard.llm.arrays import materialize
from tableguard.llm.queries import ORACLES, QUERIES
from tools.compare import digest

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_parity(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df, sql = QUERIES[name](spark, DATA), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(sql.columns, sql.fetchall())[0]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = docs
    for name, stage in P.STAGES[:-1]:
        kept = materialize(stage(spark, held, DATA), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= held.count()
        held = kept
    groups = ngram_join.near_groups(held)
    assert groups.where("component_id <> doc_id").count() == 0
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.decontaminate(held, items).where(F.size("words") > 0).count() == 0
    mixed = P.STAGES[-1][1](spark, held, DATA).collect()
    by = {r.source: 0 for r in mixed}
    for r in mixed:
        by[r.source] += r.taken
        assert r.taken <= 3 * r.size
    assert all(abs(by[r.source] - r.target) <= 1 for r in mixed)
    assert P.run(spark, DATA).count() == len(mixed)
