"""Edge rows of every verdict rule (FIXTURES §3), evaluated by Spark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableguard import CheckConfigError, CheckSpec, RunContext, Suite, TableRef, Threshold, run_suite
from tableguard.functions import band_bounds, relative_change_pass, source_count_pass

CTX = RunContext.create("2024-03-31 06:00:00", now="2024-03-31 06:10:00", dq_key=7, env="TEST",
                        unix_user="u")

REL_CASES = [
    (100, None, "0.1", True),
    (100, 0, "0.1", False),
    (0, 100, "0.1", False),
    (None, 100, "0.1", False),
    (105, 100, "0.1", True),
    (89, 100, "0.1", False),
    (105, 100, "+0.1", True),
    (95, 100, "+0.1", False),
    (100, 100, "+0.1", True),
    (95, 100, "-0.1", True),
    (105, 100, "-0.1", False),
    (105, 100, "0.1,0.5", False),
    (130, 100, "0.1,0.5", True),
    (200, -100, "0.1", True),
]


@pytest.mark.parametrize("tgt,src,thr,expected", REL_CASES)
def test_relative_change(spark, tgt, src, thr, expected):
    t = Threshold.parse(thr)
    f = lambda x: None if x is None else float(x)
    df = spark.createDataFrame([(f(tgt), f(src))], "t double, s double")
    got = df.select(relative_change_pass(F.col("t"), F.col("s"), t.mode, t.value, t.low).alias("p")).first()[0]
    assert got is expected


@pytest.mark.parametrize("tgt,src,expected", [(10, None, False), (10, 0, False), (0, 10, False),
                                              (10, 10, True), (12, 10, False)])
def test_compare_to_source_rule(spark, tgt, src, expected):
    df = spark.createDataFrame([(tgt, src)], "t bigint, s bigint")
    assert df.select(source_count_pass(F.col("t"), F.col("s"), 0.1)).first()[0] is expected


def test_threshold_parsing():
    assert Threshold.parse("+0.1").mode == "upward"
    assert Threshold.parse("-0.1").value == -0.1
    r = Threshold.parse("0.1,0.5")
    assert (r.mode, r.low, r.value, r.text) == ("range", 0.1, 0.5, "0.1,0.5")
    # Only a leading sign selects a direction: scientific notation stays absolute.
    assert Threshold.parse("1e-05").mode == "absolute"
    assert Threshold.parse(0.1, mode="upward").text == "+0.1"
    with pytest.raises(CheckConfigError):
        Threshold.parse("1.5")
    with pytest.raises(CheckConfigError):
        CheckSpec.make("std_dev", columns=["count(*)"], threshold="1,2")
    assert CheckSpec.make("std_dev", columns=["x"]).threshold.text == "1"
    assert CheckSpec.make("std_dev", columns=["x"], threshold="10").threshold.value == 10


def test_spec_validation():
    with pytest.raises(CheckConfigError):
        CheckSpec.make("bogus", columns=["a"])
    with pytest.raises(CheckConfigError):
        CheckSpec.make("unique")
    with pytest.raises(CheckConfigError):
        CheckSpec.make("day_to_day", columns=["count(*)"], group_by="d", num_days=31)
    with pytest.raises(CheckConfigError):
        CheckSpec.make("day_to_day", columns=["count(*)"], num_days=3)
    with pytest.raises(CheckConfigError):
        CheckSpec.make("compare_to_source")
    assert CheckSpec.make("trending_fast", columns=["count(*)"]).family == "trending"
    assert CheckSpec.make("std_dev_2", columns=["count(*)"]).dq_name == "std_dev"


def _run(spark, rows, schema, specs, ctx=CTX, history=None, filt=None):
    df = spark.createDataFrame(rows, schema)
    out = run_suite(spark, Suite(TableRef("d.s.t", df, filt), specs), ctx, history)
    return {(r["check_id"], r["dq_column"]): r for r in out.collect()}


def test_empty_null_counts_empty_text_and_null(spark):
    res = _run(spark, [("",), (None,), (" ",), ("a",)], "c string",
               [CheckSpec.make("empty_null", columns=["c"])])
    r = res[("empty_null", "c")]
    assert (r["dq_tgt_value"], r["is_pass"], r["dq_src_value"], r["dq_threshold"]) == ("2", False, "0", "0")


def test_empty_table_rules(spark):
    specs = [CheckSpec.make("empty_null", columns=["c"]), CheckSpec.make("unique", columns=["c"]),
             CheckSpec.make("up_to_date", columns=["d"]), CheckSpec.make("missing_dates", columns=["d"])]
    res = _run(spark, [], "c string, d date", specs)
    assert res[("empty_null", "c")]["dq_tgt_value"] is None and not res[("empty_null", "c")]["is_pass"]
    u = res[("unique", "c")]
    assert (u["dq_tgt_value"], u["dq_src_value"], u["is_pass"]) == ("0", "0", True)
    assert res[("up_to_date", "d")]["dq_tgt_value"] is None and not res[("up_to_date", "d")]["is_pass"]
    m = res[("missing_dates", "d")]
    assert (m["dq_tgt_value"], m["is_pass"]) == ("90", False)


def test_unique_null_and_composite(spark):
    res = _run(spark, [(1, 1), (2, None), (None, 1)], "a int, b int",
               [CheckSpec.make("unique", columns=["a"])])
    assert (res[("unique", "a")]["dq_tgt_value"], res[("unique", "a")]["dq_src_value"]) == ("2", "3")
    res = _run(spark, [(1, 1), (1, None), (2, 1), (2, 1)], "a int, b int",
               [CheckSpec.make("unique", columns=["a,b"])])
    r = res[("unique", "a,b")]
    assert (r["dq_tgt_value"], r["dq_src_value"], r["is_pass"]) == ("2", "4", False)


def test_up_to_date_after_as_of_passes(spark):
    res = _run(spark, [(dt.date(2024, 4, 2),)], "d date", [CheckSpec.make("up_to_date", columns=["d"])])
    r = res[("up_to_date", "d")]
    assert r["is_pass"] and r["dq_src_value"] == "2024-03-31" and r["dq_threshold"] is None


def test_missing_dates_single_date(spark):
    res = _run(spark, [(dt.date(2024, 3, 1),)] * 3, "d date", [CheckSpec.make("missing_dates", columns=["d"])])
    assert res[("missing_dates", "d")]["dq_tgt_value"] == "89"
    res = _run(spark, [(dt.date(2024, 3, 1) - dt.timedelta(days=i),) for i in range(90)], "d date",
               [CheckSpec.make("missing_dates", columns=["d"])])
    assert res[("missing_dates", "d")]["is_pass"]
    res = _run(spark, [(dt.date(2024, 3, 1) - dt.timedelta(days=i),) for i in range(10)], "d date",
               [CheckSpec.make("missing_dates", columns=["d"], window=10)])
    assert res[("missing_dates", "d")]["dq_tgt_value"] == "0"


def test_day_to_day_gaps_nulls_and_limit(spark):
    rows = [(dt.date(2024, 3, d), v) for d, v in [(1, 10), (2, 10), (5, 11), (6, 30)]]
    rows += [(None, 5)]
    spec = CheckSpec.make("day_to_day", columns=["sum(v)"], group_by="d", num_days=4, threshold="0.2")
    res = _run(spark, rows, "d date, v int", [spec])
    got = {k[1]: (r["dq_tgt_value"], r["dq_src_value"], r["is_pass"]) for k, r in res.items()}
    # NULL key sorts first (descending), its label is NULL; gaps compare neighbours.
    assert got[None] == ("5", "30", False)
    assert got["sum(v) [2024-03-06]"] == ("30", "11", False)
    assert got["sum(v) [2024-03-05]"] == ("11", "10", True)
    assert got["sum(v) [2024-03-02]"] == ("10", None, True)
    assert len(got) == 4


def test_day_to_day_composite_key_is_text(spark):
    rows = [("x", 1), ("x", 2), ("y", 1), (None, 1)]
    spec = CheckSpec.make("day_to_day", columns=["count(*)"], group_by="k,v", num_days=10)
    res = _run(spark, rows, "k string, v int", [spec])
    cols = sorted((k[1] or "<null>") for k in res)
    assert cols == ["<null>", "count(*) [x,1]", "count(*) [x,2]", "count(*) [y,1]"]


def test_custom_null_result_fails(spark):
    spec = CheckSpec.custom("c", "SELECT 1 AS tgt_value, CAST(NULL AS INT) AS src_value, "
                                 "CAST(NULL AS INT) AS result UNION ALL SELECT 2, 2, 0")
    res = run_suite(spark, Suite(TableRef("d.s.t", spark.range(1)), [spec]), CTX).collect()
    by = {r["dq_tgt_value"]: r for r in res}
    assert not by["1"]["is_pass"] and by["2"]["is_pass"]
    assert by["1"]["is_dq_custom"] and by["1"]["table_filter"] is None and by["1"]["dq_column"] == ""


def test_custom_sql_args(spark):
    spec = CheckSpec.custom("c", "SELECT count(*) AS tgt_value, :lim AS src_value, "
                                 "CASE WHEN count(*) > :lim THEN 1 ELSE 0 END AS result FROM {t}",
                            args={"lim": 5}, frames={"t": spark.range(3)})
    r = run_suite(spark, Suite(TableRef("d.s.t", spark.range(1)), [spec]), CTX).first()
    assert (r["dq_tgt_value"], r["dq_src_value"], r["is_pass"]) == ("3", "5", True)


def test_band_bounds_quirk(spark):
    df = spark.createDataFrame([(110, 10 / 7, 10.690449676496975)], "last long, a double, s double")
    lo, hi = band_bounds(F.col("last"), F.col("a"), F.col("s"), 2.0)
    assert tuple(df.select(lo, hi).first()) == (88, 132)
    lo, _ = band_bounds(F.col("last"), F.col("a"), F.col("s"), -2.0)
    assert df.select(lo).first()[0] == 130


def test_filter_text_and_disabled(spark):
    specs = [CheckSpec.make("unique", columns=["a"]), CheckSpec.make("empty_null", columns=["a"], enabled=False)]
    res = _run(spark, [(1,), (2,)], "a int", specs, filt="a > 0")
    assert list(res) == [("unique", "a")]
    assert res[("unique", "a")]["table_filter"] == "a > 0"
    res = _run(spark, [(1,)], "a int", specs[:1], filt="1=1")
    assert res[("unique", "a")]["table_filter"] == ""


def test_sql_text_verdicts_agree_with_columns(spark):
    from tableguard.functions import sql as Q
    rows = []
    for tgt, src, thr, expected in REL_CASES:
        t = Threshold.parse(thr)
        rows.append((None if tgt is None else float(tgt), None if src is None else float(src),
                     t.mode, float(t.value), t.low, expected))
    df = spark.createDataFrame(rows, "t double, s double, mode string, v double, lo double, exp boolean")
    out = df.select("exp", relative_change_pass(F.col("t"), F.col("s"), F.col("mode"), F.col("v"),
                                                F.col("lo")).alias("col"),
                    F.expr(Q.relative_change_pass("t", "s", "mode", "v", "lo")).alias("sql"),
                    source_count_pass(F.col("t"), F.col("s"), F.col("v")).alias("c2"),
                    F.expr(Q.source_count_pass("t", "s", "v")).alias("s2")).collect()
    for r in out:
        assert r["exp"] == r["col"] == r["sql"]
        assert r["c2"] == r["s2"]
    b = spark.createDataFrame([(110, 10 / 7, 10.690449676496975, 2.0, 120.0)],
                              "last long, a double, sd double, t double, tgt double")
    lo, hi = Q.band_bounds("last", "a", "sd", "t")
    clo, chi = band_bounds(F.col("last"), F.col("a"), F.col("sd"), F.col("t"))
    r = b.select(F.expr(lo), F.expr(hi), clo, chi).first()
    assert tuple(r) == (88, 132, 88, 132)


def test_composite_keys_split_at_top_level(spark):
    from tableguard.functions.sql import split_top_level
    assert split_top_level("a, coalesce(b, 0), 'x,y'") == ["a", "coalesce(b, 0)", "'x,y'"]
    rows = [(1, None), (1, 0), (2, 5)]
    res = _run(spark, rows, "a int, b int", [CheckSpec.make("unique", columns=["a,coalesce(b, 0)"])])
    r = res[("unique", "a,coalesce(b, 0)")]
    assert (r["dq_tgt_value"], r["dq_src_value"]) == ("2", "3")
    spec = CheckSpec.make("day_to_day", columns=["count(*)"], group_by="a, coalesce(b, -1)", num_days=5)
    res = _run(spark, rows, "a int, b int", [spec])
    assert sorted(k[1] for k in res) == ["count(*) [1,-1]", "count(*) [1,0]", "count(*) [2,5]"]


def test_rules_from_config(spark, tmp_path):
    from tableguard import rules_from_config
    sql_file = tmp_path / "orphans.sql"
    sql_file.write_text("SELECT 0 AS tgt_value, 0 AS src_value, 0 AS result")
    dq = {
        "trending_week": {"enabled": True, "columns": ["count(*)"], "threshold": 0.1, "compare_type": "week"},
        "day_to_day": {"enabled": True, "columns": ["count(*)"], "group_by": "d", "num_days": 7,
                       "threshold": "0.1,0.5", "stop_on_failure": True},
        "std_dev": {"enabled": False, "columns": ["count(*)"]},
        "compare_to_source": {"enabled": True, "threshold": 0.2},
    }
    custom = {"orphans": {"enabled": True, "sql_file": str(sql_file), "description": "none"}}
    src = TableRef("a.b.src", spark.range(3))
    specs = {s.check_id: s for s in rules_from_config(dq, custom, source=src)}
    assert specs["trending_week"].compare_type == "week" and specs["trending_week"].threshold.text == "0.1"
    assert specs["day_to_day"].threshold.mode == "range" and specs["day_to_day"].stop_on_failure
    assert not specs["std_dev"].enabled and specs["std_dev"].threshold.text == "1"
    assert specs["compare_to_source"].source is src
    r = run_suite(spark, Suite(TableRef("a.b.t", spark.range(1)), [specs["orphans"]]), CTX).first()
    assert r["is_pass"] and r["dq_name"] == "orphans"
    with pytest.raises(CheckConfigError):
        rules_from_config({"unique": {"columns": ["a"]}})
    with pytest.raises(CheckConfigError):
        rules_from_config({"day_to_day": {"enabled": True, "columns": ["c"], "group_by": "d", "num_days": 31}})


def test_decimal_metric_text_is_exact(spark):
    from decimal import Decimal
    rows = [(Decimal("12345678901234567.89"),), (Decimal("0.01"),)]
    res = _run(spark, rows, "p decimal(20,2)", [CheckSpec.make("trending", columns=["sum(p)"])])
    r = res[("trending", "sum(p)")]
    assert r["dq_tgt_value"] == "12345678901234567.90" and r["dq_tgt_num"] == pytest.approx(1.2345678901234568e16)


@pytest.mark.parametrize("unit", [1e6, 9e18, 1e19, 1e60])
def test_std_dev_judges_values_beyond_bigint(spark, unit):
    """Weeks at 1.00, 1.03 and 1.05 units: the rules tell a target inside the band from one far outside."""
    specs = [CheckSpec.make("std_dev", columns=["sum(v)"], threshold="2"),
             CheckSpec.make("std_dev_up", columns=["sum(v)"], threshold="+2"),
             CheckSpec.make("std_dev_down", columns=["sum(v)"], threshold="-2", corrected=True)]
    history = None
    for k, v in ((3, 1.00), (2, 1.03), (1, 1.05)):
        day = dt.date(2024, 3, 31) - dt.timedelta(days=7 * k)
        ctx = RunContext.create(f"{day} 06:00:00", now=f"{day} 06:10:00", dq_key=100 + k, env="TEST", unix_user="u")
        rows = run_suite(spark, Suite(TableRef("d.s.t", spark.createDataFrame([(v * unit,)], "v double")), specs[:1]), ctx)
        history = rows if history is None else history.unionByName(rows)
    history = spark.createDataFrame(history.collect(), history.schema)
    for v, passes in ((1.06, [True, True, True]), (5.0, [False, False, True]), (-5.0, [False, True, False])):
        got = _run(spark, [(v * unit,)], "v double", specs, history=history)
        assert [got[(s.check_id, "sum(v)")]["is_pass"] for s in specs] == passes, v
        source = got[("std_dev", "sum(v)")]["dq_src_value"]
        assert "(cnt=3)" in source and "(last_src=0)" not in source


def test_band_pass_needs_finite_bounds(spark):
    from tableguard.functions import band_pass
    from tableguard.functions import sql as Q
    inf, nan = float("inf"), float("nan")
    rows = [(t, lo, hi, mode, False) for mode in ("absolute", "upward", "downward")
            for t, lo, hi in ((1.0, -inf, inf), (1.0, nan, nan), (nan, nan, nan), (nan, 0.0, 2.0), (inf, 0.0, 2.0))]
    rows += [(1.0, 0.0, 2.0, "absolute", True), (1.0, None, None, "upward", True)]
    df = spark.createDataFrame(rows, "t double, lo double, hi double, mode string, exp boolean")
    for r in df.select("*", band_pass(F.col("t"), F.col("lo"), F.col("hi"), F.col("mode")).alias("col"),
                       F.expr(Q.band_pass("t", "lo", "hi", "mode")).alias("sql")).collect():
        assert r["exp"] == r["col"] == r["sql"], tuple(r)
