"""The per-family functions (one-rule suites) agree with the fused suite."""

import datetime as dt

from pyspark.sql import functions as F

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.operators import checks as C

CTX = RunContext.create("2024-03-31 06:00:00", now="2024-03-31 06:10:00", dq_key=5, env="TEST")


def _t(spark):
    rows = [(i, dt.date(2024, 3, 1) + dt.timedelta(days=i % 31), None if i % 7 == 0 else f"v{i % 5}")
            for i in range(200)]
    return TableRef("d.s.t", spark.createDataFrame(rows, "id long, d date, s string"))


def test_family_functions_match_fused_suite(spark):
    t = _t(spark)
    src = TableRef("d.s.src", spark.range(190))
    singles = [
        C.trending(t, None, ["count(*)"], CTX, threshold="0.1"),
        C.compare_to_source(t, src, CTX, threshold="0.1"),
        C.empty_null(t, ["s"], CTX),
        C.unique(t, ["id", "s"], CTX),
        C.up_to_date(t, ["d"], CTX),
        C.day_to_day(t, ["count(*)"], "d", 5, CTX, threshold="0.2"),
        C.missing_dates(t, ["d"], CTX, window=40),
        C.std_dev(t, None, ["count(*)"], CTX),
        C.custom(t, "c", "SELECT 1 AS tgt_value, 1 AS src_value, 0 AS result", CTX),
    ]
    specs = [CheckSpec.make("trending", columns=["count(*)"], threshold="0.1"),
             CheckSpec.make("compare_to_source", threshold="0.1", source=src),
             CheckSpec.make("empty_null", columns=["s"]),
             CheckSpec.make("unique", columns=["id", "s"]),
             CheckSpec.make("up_to_date", columns=["d"]),
             CheckSpec.make("day_to_day", columns=["count(*)"], group_by="d", num_days=5, threshold="0.2"),
             CheckSpec.make("missing_dates", columns=["d"], window=40),
             CheckSpec.make("std_dev", columns=["count(*)"]),
             CheckSpec.custom("c", "SELECT 1 AS tgt_value, 1 AS src_value, 0 AS result")]
    fused = run_suite(spark, Suite(t, specs), CTX)
    key = ["check_id", "dq_column", "dq_tgt_value", "dq_src_value", "dq_threshold", "is_pass"]
    one_by_one = set()
    for df in singles:
        one_by_one |= {tuple(r[k] for k in key) for r in df.collect()}
    assert one_by_one == {tuple(r[k] for k in key) for r in fused.collect()}
    got = {r["check_id"]: r for r in fused.collect() if r["dq_column"] in ("d", "count(*)")}
    assert got["missing_dates"]["dq_tgt_value"] == "9"   # 31 present days in a 40-day spine
    assert got["compare_to_source"]["dq_tgt_value"] == "200"


def test_negative_parameters_are_bracketed(spark):
    from tableguard.spec import bind
    assert bind("sum(v)-:x", {"x": -1}) == "sum(v)-(-1)"
    assert spark.sql("SELECT " + bind("3-:x", {"x": -2}) + " AS n").first().n == 5
    assert bind(":a :b", {"a": -1.5, "b": 2}) == "CAST('-1.5' AS DOUBLE) 2"
