"""Rule identity, parameters, wrapped and distinct aggregates, and the delete + insert writer."""

import datetime as dt

import pytest

from tableguard import CheckSpec, RunContext, Suite, TableRef, expected_rules, run_suite
from tableguard.operators import loads as L
from tableguard.operators import results as R
from tableguard.plans.suite import _filterable
from tableguard.spec import CheckConfigError, bind, rules_from_config

CTX = RunContext.create("2024-05-01 06:00:00", now="2024-05-01 06:30:00", dq_key=7, env="T")


def _table(spark):
    return spark.createDataFrame([(1, "x", 2.5), (2, "x", 4.0), (3, "y", None), (3, None, 1.0)],
                                 "id int, kind string, v double")


def test_rule_ids_are_unique_in_a_suite(spark):
    specs = [CheckSpec.make("trending", columns=["count(*)"], compare_type=c) for c in ("day", "week")]
    with pytest.raises(CheckConfigError, match="unique"):
        Suite(TableRef("a.b.t", _table(spark)), specs)


def test_stop_gate_sees_the_failing_schema(spark):
    good, bad = _table(spark).where("id < 3"), _table(spark)
    suites = [Suite(TableRef(f"a.{s}.t", df), [CheckSpec.make("unique", columns=["id"], stop_on_failure=True)])
              for s, df in (("s1", good), ("s2", bad))]
    out = run_suite(spark, suites, CTX)
    expected = expected_rules(spark, suites, CTX)
    assert sorted(r.result for r in R.summary(out, 7, expected).collect()) == ["FAIL", "PASS"]
    assert R.stop_gate_rows(out, 7, expected).count() == 1
    with pytest.raises(R.StopOnFailure):
        R.stop_gate(out, 7, expected)


def test_null_target_fails_in_every_report(spark):
    spec = CheckSpec.custom("c", "SELECT CAST(NULL AS INT) tgt_value, 0 src_value, 0 result", stop_on_failure=True)
    out = run_suite(spark, Suite(TableRef("a.b.t", _table(spark)), [spec]), CTX)
    assert [r.result for r in R.summary(out, 7).collect()] == ["FAIL"]
    assert R.failures(out, 7).count() == 1 and R.stop_gate_rows(out, 7).count() == 1


def test_wrapped_aggregates_of_several_filters(spark):
    df = _table(spark)
    assert _filterable(df, "sum(v)") and _filterable(df, "count(DISTINCT kind)")
    assert not any(_filterable(df, t) for t in ("coalesce(sum(v), 0)", "round(avg(v), 2)", "CAST(sum(v) AS INT)"))
    columns = ["coalesce(sum(v), 0)", "round(avg(v), 2)", "CAST(sum(v) AS DOUBLE)", "sum(v)"]
    specs = lambda: [CheckSpec.make("trending", columns=columns),
                     CheckSpec.make("day_to_day", columns=columns, group_by="id", num_days=5)]
    filters = ["kind = 'x'", "kind = 'none'", None]
    both = run_suite(spark, [Suite(TableRef("a.b.t", df, f), specs()) for f in filters], CTX)
    alone = [r for f in filters for r in run_suite(spark, Suite(TableRef("a.b.t", df, f), specs()), CTX).collect()]
    key = lambda r: (r.table_filter, r.check_id, r.dq_column, r.dq_tgt_value, r.dq_src_value, r.is_pass)
    assert sorted(map(str, map(key, both.collect()))) == sorted(map(str, map(key, alone)))


def test_distinct_counts_need_no_expand(spark):
    columns = ["count(DISTINCT id)", "count(DISTINCT kind)", "count(DISTINCT v)", "sum(v)"]
    out = run_suite(spark, Suite(TableRef("a.b.t", _table(spark)), [CheckSpec.make("trending", columns=columns)]), CTX)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.dq_column: r.dq_tgt_num for r in out.collect()} == dict(zip(columns, (3, 2, 3, 7.5)))


def test_parameters_in_columns_keys_and_custom_sql(spark):
    args = {"lo": 2, "day": dt.date(2024, 5, 1), "who": "o'x"}
    assert bind("a > :lo AND b = ':lo' AND c::int = :other AND d = :day AND e = :who", args) == (
        "a > 2 AND b = ':lo' AND c::int = :other AND d = DATE'2024-05-01' AND e = 'o\\'x'")
    rules = rules_from_config(
        {"trending": {"enabled": True, "columns": ["sum(CASE WHEN id > :lo THEN 1 ELSE 0 END)"]},
         "day_to_day": {"enabled": True, "columns": ["count(*)"], "group_by": "id + :lo", "num_days": 1}},
        {"own": {"enabled": True, "sql": "SELECT :lo tgt_value, 2 src_value, :lo - 2 result"}})
    out = run_suite(spark, Suite(TableRef("a.b.t", _table(spark), "id >= :lo", args=args), rules), CTX)
    assert {r.check_id: r.dq_tgt_value for r in out.collect()} == {"trending": "2", "day_to_day": "2", "own": "2"}


def test_disabled_rules_are_not_validated(spark):
    specs = rules_from_config({"no_such_rule": {"enabled": False}, "compare_to_source": {"enabled": False}},
                              {"own": {"enabled": False}})
    assert [s.enabled for s in specs] == [False] * 3


def test_segments_keep_their_own_baselines(spark, scratch):
    def suites(segments):
        return [Suite(TableRef("a.b.t", _table(spark), f, segment=g), [CheckSpec.make("trending", columns=["count(*)"])])
                for f, g in zip(("kind = 'x'", "kind = 'y'"), segments)]
    R.append_results(run_suite(spark, suites(("x", "y")), CTX), f"{scratch}/r")
    later = RunContext.create("2024-05-02 06:00:00", now="2024-05-02 06:30:00", dq_key=8, env="T")
    history = R.read_results(spark, f"{scratch}/r")
    out = run_suite(spark, suites(("x", "y")), later, history)
    assert {r.table_name: (r.dq_tgt_value, r.dq_src_value) for r in out.collect()} == {
        "t/x": ("2", "2"), "t/y": ("1", "1")}
    assert R.verdicts(out).count() == 2 and expected_rules(spark, suites(("x", "y")), later).count() == 2
    with pytest.warns(UserWarning, match="segment"):
        run_suite(spark, suites(("", "")), later, history)


def test_delete_insert_writer_rewrites_touched_partitions(spark, scratch):
    spark.sql("DROP TABLE IF EXISTS t_del")
    spark.sql(f"CREATE TABLE t_del (id int, v int, p string) USING parquet PARTITIONED BY (p) LOCATION '{scratch}/t'")
    rows = [(1, 1, "a"), (2, None, "a"), (3, 3, "b"), (4, 9, None), (5, 9, "c"), (6, 1, "d")]
    spark.createDataFrame(rows, "id int, v int, p string").write.mode("append").insertInto("t_del")
    new = spark.createDataFrame([(7, 7, "b")], "id int, v int, p string")
    want = sorted(map(str, L.stage(spark.table("t_del"), new, "v = 9 OR id = 1").collect()))
    assert L.write_delete_insert(spark, "t_del", new, "v = 9 OR id = 1", f"{scratch}/stage") == 4
    assert sorted(map(str, spark.table("t_del").collect())) == want
    assert L.write_delete_insert(spark, "t_del", new.limit(0), "id = 999", f"{scratch}/stage2") == 0
    assert sorted(map(str, spark.table("t_del").collect())) == want
