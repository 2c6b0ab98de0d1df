"""Partitions that an update touches, from kept key ranges."""

import uuid

import pytest
from pyspark.sql import functions as F

from tableguard import RunContext
from tableguard.operators import loads as L
from tableguard.operators.partials import KeyRanges

CTX = RunContext.create("2024-03-01 06:00:00", now="2024-03-01 06:30:00", dq_key=5, env="TEST")
COLS = [("id", "bigint"), ("k2", "string"), ("v", "string"), ("p", "string"), ("q", "int")]


@pytest.fixture()
def table(spark, scratch):
    name = f"kr_{uuid.uuid4().hex}"
    L.create_table(spark, name, COLS, ["p", "q"], f"{scratch}/t")
    rows = spark.range(1000).selectExpr("id", "CAST(id % 7 AS STRING) AS k2", "'old' AS v", "CASE WHEN id < 100 THEN NULL WHEN id < 200 THEN 'it''s' "
                                        "ELSE concat('0', CAST(id DIV 100 AS STRING)) END AS p", "CAST(id DIV 500 AS INT) AS q")
    L.write_overwrite(spark, name, L.overwrite(rows, COLS, CTX))
    yield name
    spark.sql(f"DROP TABLE {name}")


def _source(spark, ids):
    return spark.createDataFrame([(i, str(i % 7), "new", "09", 1) for i in ids], "id long, k2 string, v string, p string, q int")


def _parts(df):
    return sorted((r.p or "", r.q) for r in df.collect())


@pytest.mark.parametrize("ids", [[3, 5], [150], [120, 420, 430], [99, 100, 999], list(range(0, 1000, 3)), [5000], []])
@pytest.mark.parametrize("key", ["id", ["id", "k2"]])
def test_same_table_as_a_full_search(spark, scratch, table, ids, key):
    src = _source(spark, ids)
    ranges = KeyRanges(spark, table, key, f"{scratch}/ranges", intervals=8)
    want = L.upsert(spark.table(table), src, key, COLS, CTX, restamp=False)
    want = sorted(map(str, want.select("id", "k2", "v", "p", "q").collect()))
    holding = _parts(spark.table(table).where(F.col("id").isin(ids)).select("p", "q").distinct())
    found = _parts(ranges.candidates(src))
    assert set(holding) <= set(found)
    if len(ids) < 4:
        assert found == holding
    L.write_upsert_partitions(spark, table, src, key, COLS, CTX, f"{scratch}/stage", ranges=ranges)
    assert sorted(map(str, spark.table(table).select("id", "k2", "v", "p", "q").collect())) == want


def test_ranges_follow_the_table(spark, scratch, table):
    ranges = KeyRanges(spark, table, "id", f"{scratch}/ranges")
    src = _source(spark, [250])
    assert _parts(ranges.candidates(src)) == [("02", 0)] and len(ranges.kept.scanned) == 10
    # written past the ranges: the key moves to partition 09, and partition 02 loses it
    L.write_upsert_partitions(spark, table, src, "id", COLS, CTX, f"{scratch}/stage")
    again = KeyRanges(spark, table, "id", f"{scratch}/ranges")
    assert _parts(again.candidates(src)) == [("02", 0), ("09", 1)]          # 02: 200 to 299 still meets 250
    assert len(again.kept.scanned) == 2
    assert _parts(again.candidates(_source(spark, [901]))) == [("09", 1)] and again.kept.scanned == []


def test_scan_reads_only_the_named_partitions(spark, table):
    tgt = L.in_partitions(spark.table(table), ["p", "q"], [(None, 0), ("it's", 0), ("02", 0)])
    assert sorted(r.p or "" for r in tgt.select("p").distinct().collect()) == ["", "02", "it's"]
    plan = tgt._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and len(tgt.inputFiles()) > 0
    assert L.in_partitions(spark.table(table), ["p", "q"], []).count() == 0


def test_keys_of_another_type_are_refused(spark, scratch, table):
    ranges = KeyRanges(spark, table, "id", f"{scratch}/ranges")
    with pytest.raises(L.LoadConfigError):
        ranges.candidates(spark.createDataFrame([("7",)], "id string"))


def test_a_table_without_partitions_is_refused(spark, scratch):
    name = f"kr_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet LOCATION '{scratch}/t'")
    try:
        with pytest.raises(L.LoadConfigError):
            KeyRanges(spark, name, "id", f"{scratch}/ranges")
    finally:
        spark.sql(f"DROP TABLE {name}")
