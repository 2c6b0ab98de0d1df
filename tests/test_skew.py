"""A key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.operators import loads as L

CTX = RunContext.create("2024-03-31 06:00:00", now="2024-03-31 06:10:00", dq_key=11, env="TEST")
N = 30000


def _skewed(spark):
    # ids 0..N-1; a third of the rows share key 7 and day 2024-03-30
    df = spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2024, 3, 30)))
        .otherwise(F.date_sub(F.lit(dt.date(2024, 3, 30)), (F.col("id") % 60).cast("int"))).alias("d"))
    return df.repartition(16)


def test_skewed_unique_day_to_day_missing(spark):
    df = _skewed(spark)
    specs = [CheckSpec.make("unique", columns=["k", "id", "k,d"]),
             CheckSpec.make("day_to_day", columns=["count(*)"], group_by="d", num_days=3),
             CheckSpec.make("missing_dates", columns=["d"])]
    res = {(r["check_id"], r["dq_column"]): r for r in run_suite(spark, Suite(TableRef("a.b.c", df), specs), CTX).collect()}
    hot = N // 3
    assert res[("unique", "id")]["dq_tgt_value"] == str(N)
    assert res[("unique", "k")]["dq_tgt_value"] == str(df.select("k").distinct().count())
    assert hot == df.where("k = 7").count() - 1
    assert res[("unique", "k")]["dq_src_value"] == str(N)
    exact = df.select("k", "d").distinct().count()
    assert res[("unique", "k,d")]["dq_tgt_value"] == str(exact)
    top = res[("day_to_day", "count(*) [2024-03-30]")]
    assert int(top["dq_tgt_value"]) == df.where("d = DATE'2024-03-30'").count()
    # present: day 0 (hot rows) and the 40 offsets in 1..59 not divisible by 3
    present = df.select("d").distinct().count()
    assert present == 41
    assert res[("missing_dates", "d")]["dq_tgt_value"] == str(90 - present)


def test_skewed_upsert_keeps_every_row(spark):
    cols = [("id", "bigint"), ("k", "bigint")]
    tgt = L.with_audit(_skewed(spark).select("id", "k"), CTX)
    src = spark.range(0, N, 2).select(F.col("id"), F.lit(7).cast("bigint").alias("k"))
    out = L.upsert(tgt, src, ["id"], cols, CTX)
    assert out.count() == N
    # every source row, plus kept target rows whose k is already 7 (the hot third and id 7)
    assert out.where("k = 7").count() == len(set(range(0, N, 2)) | set(range(0, N, 3)) | {7})
