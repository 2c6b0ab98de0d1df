"""Last-run baselines over a stored history, distinct counts over filters, and sharing without a cache."""

import datetime as dt
import os
import re

import pytest

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.operators import history as H
from tableguard.operators import results as R

from conftest import SF001

CTX = RunContext.create("2024-03-01 06:00:00", now="2024-03-01 06:30:00", dq_key=99, env="TEST")


def _row(spark, day, column, value, key, hour=6):
    at = f"TIMESTAMP_NTZ'{day} {hour:02d}:00:00'"
    have = {"dq_run_hour": at, "database_name": "'d'", "schema_name": "'s'", "table_name": "'t'", "dq_name": "'trending'",
            "dq_column": f"'{column}'", "dq_tgt_value": f"'{value}'", "dq_key": f"{key}L", "dq_end_tstamp": at, "env": "'TEST'",
            "check_id": "'x'", "dq_tgt_num": f"{value}D" if value is not None else "NULL", "dq_run_date": f"DATE'{day}'"}
    return spark.sql("SELECT " + ", ".join(f"CAST({have.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
                                           for f in R.RESULT_SCHEMA.fields))


@pytest.fixture
def stored(spark, tmp_path):
    day = lambda n: (CTX.as_of - dt.timedelta(days=n)).isoformat()
    rows = [_row(spark, day(n), "near", 100 + n, n) for n in range(1, 40)]
    rows += [_row(spark, day(20), "far", 7, 20), _row(spark, day(33), "far", 8, 33), _row(spark, day(20), "far", 9, 21, 9)]
    rows += [_row(spark, day(0), "near", 1, 99), _row(spark, day(0), "later", 1, 98, 9), _row(spark, day(5), "empty", None, 5)]
    path = str(tmp_path / "results")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    R.append_results(out, path)
    return path


def _wanted(*columns, cmp=None):
    return [("r", "d", "s", "t", c, cmp) for c in columns]


def test_probes_stop_when_every_series_is_found(spark, stored, monkeypatch):
    history = R.stored_results(spark, stored)
    assert history.dates[0] == CTX.as_of and len(history.dates) == 40
    read = []
    newest = H._newest
    monkeypatch.setattr(H, "_newest", lambda h, w, c, dates: read.append((len(w), dates)) or newest(h, w, c, dates))
    got = {r.dq_column: r.base_num for r in H.trending_baselines(history, _wanted("near"), CTX, [None]).collect()}
    assert got == {"near": 101.0} and [len(d) for _, d in read] == [1, 2]
    read.clear()
    wanted = _wanted("near", "far", "empty", "later") + _wanted("near", cmp=CTX.as_of - dt.timedelta(days=7))[:0]
    got = {r.dq_column: r.base_num for r in H.trending_baselines(history, wanted, CTX, [None]).collect()}
    # "later" was written after this run's hour: not found, so all dates are read; every date once
    assert got == {"near": 101.0, "far": 9.0, "empty": None}
    assert [len(d) for _, d in read] == [1, 2, 4, 8, 16, 9] and [n for n, _ in read] == [4, 4, 3, 2, 2, 1]
    assert sorted(x for _, d in read for x in d) == sorted(history.dates)


def test_same_as_one_pass_over_all_rows(spark, stored):
    history, day = R.stored_results(spark, stored), CTX.as_of - dt.timedelta(days=7)
    wanted = _wanted("near", "far", "empty", "none") + [("w", "d", "s", "t", "near", day), ("w", "d", "s", "t", "far", day)]
    rows = lambda h: sorted(map(tuple, H.trending_baselines(h, wanted, CTX, [None, day]).collect()), key=str)
    assert rows(history) == rows(history.frame) == [("r", "empty", None), ("r", "far", 9.0), ("r", "near", 101.0), ("w", "near", 107.0)]


def test_dated_rules_read_their_date_only(spark, stored):
    """A last-run rule beside them widens nothing, and the series reach the scan as static predicates."""
    history, day = R.stored_results(spark, stored), CTX.as_of - dt.timedelta(days=7)
    wanted = _wanted("near") + [("w", "d", "s", "t", "near", day)]
    query = H.trending_baselines(history, wanted, CTX, [None, day])._jdf.queryExecution()
    plan = query.executedPlan().toString()
    scan = re.findall(r"PartitionFilters: \[[^\]]*\]", plan)
    assert len(scan) == 1 and day.isoformat() in scan[0] and "<=" not in scan[0]
    rows = query.optimizedPlan().toString()
    assert re.search(r"Filter .*table_name#\d+ = t.*\n? *.*Relation", rows) and re.search(r"dq_column#\d+ = near", rows)


def test_stored_in_a_catalog_table(spark, stored):
    spark.sql("DROP TABLE IF EXISTS t_stored_results")
    R.create_results(spark, "t_stored_results")
    try:
        R.append_results(R.read_results(spark, stored), table="t_stored_results")
        by_table, by_path = R.stored_results(spark, table="t_stored_results"), R.stored_results(spark, stored)
        assert by_table.dates == by_path.dates
        rows = lambda h: sorted(map(tuple, H.trending_baselines(h, _wanted("near", "far"), CTX, [None]).collect()))
        assert rows(by_table) == rows(by_path)
    finally:
        spark.sql("DROP TABLE IF EXISTS t_stored_results")


def test_suite_over_a_stored_history(spark, stored):
    t = spark.range(110).selectExpr("id AS v")
    specs = [CheckSpec.make("trending", columns=["near"], threshold="0.1")]
    target = TableRef("d.s.t", t.selectExpr("v AS near").groupBy().agg({"near": "count"}).selectExpr("100D AS near").limit(1))
    specs = [CheckSpec(**{**specs[0].__dict__, "columns": ("count(*)",)})]
    empty = run_suite(spark, Suite(target, specs), CTX, R.StoredResults(R.empty_results(spark), [])).first()
    assert empty.dq_src_value is None and empty.is_pass


def test_distinct_counts_of_many_filters(spark, monkeypatch):
    """More filters than one mask has bits; NULL keys and NULL filters do not count."""
    from tableguard.plans import suite
    monkeypatch.setattr(suite, "_MASK_BITS", 3)
    df = spark.sql("SELECT id % 7 AS a, IF(id % 5 = 0, NULL, id % 11) AS b, IF(id % 3 = 0, NULL, id) AS n FROM range(500)")
    metrics = ["count(DISTINCT a)", "COUNT( distinct b )", "count(DISTINCT a, b)", "sum(DISTINCT a)", "count(DISTINCT a) + 1"]
    filters = [None, "n > 490", "n IS NULL AND a = 1", "false", "n = 4", "n < 9"]
    specs = lambda: [CheckSpec.make("trending", columns=metrics, threshold="0.1")]
    rows = run_suite(spark, [Suite(TableRef("d.s.t", df, f, segment=f"s{i}"), specs()) for i, f in enumerate(filters)], CTX).collect()
    got = {(r.table_name, r.dq_column): r.dq_tgt_num for r in rows}
    for i in range(len(filters)):
        want = df.where(filters[i] or "true").selectExpr(*metrics).first()
        for m, x in zip(metrics, want):
            assert got[f"t/s{i}", m] == x, (filters[i], m)


def test_distinct_counts_without_expand(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    plans = []
    for filters in ([f"o_custkey % 9 = {i}" for i in range(2)], [f"o_custkey % 9 = {i}" for i in range(9)]):
        suites = [Suite(TableRef("a.b.c", orders, f, segment=f), [CheckSpec.make("trending", columns=["count(DISTINCT o_custkey)",
                  "count(DISTINCT o_orderpriority)"], threshold="0.1")]) for f in filters]
        plan = _final(run_suite(spark, suites, CTX))
        assert "Expand" not in plan
        plans.append((len(re.findall(r"Exchange hashpartitioning", plan)), plan.count("FileScan")))
    assert plans == [(2, 2), (2, 2)]


def _final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_nothing_stays_cached_and_new_files_are_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id AS v", "DATE'2024-02-28' AS d").write.parquet(path)
    specs = lambda: [CheckSpec.make("trending", columns=["count(*)"], threshold="0.1"), CheckSpec.make("missing_dates", columns=["d"]),
                     CheckSpec.make("day_to_day", columns=["count(*)", "sum(v)"], group_by="d", num_days=3)]
    suite = lambda: [Suite(TableRef("a.b.t", spark.read.parquet(path), f, segment=f or ""), specs()) for f in (None, "v < 5")]
    first, second = run_suite(spark, suite(), CTX), run_suite(spark, suite(), CTX)
    count = lambda df: {r.table_name: r.dq_tgt_num for r in df.collect() if r.dq_name == "trending"}
    assert count(first) == count(second) == {"t": 10, "t/v < 5": 5}
    assert not spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
    spark.range(3).selectExpr("id AS v", "DATE'2024-03-01' AS d").write.mode("append").parquet(path)
    assert count(run_suite(spark, suite(), CTX)) == {"t": 13, "t/v < 5": 8}
    assert os.path.isdir(path)


def test_filters_with_parameters_share_their_scan(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    specs = lambda: [CheckSpec.make("empty_null", columns=["o_custkey"]), CheckSpec.make("trending", columns=["count(*)"], threshold="0.1")]
    suites = [Suite(TableRef("a.b.o", orders, "o_orderstatus = :s", args={"s": x}, segment=x), specs()) for x in "FOP"]
    rows = run_suite(spark, suites, CTX)
    assert _final(rows).count("FileScan") == 1
    want = {f"o/{r.o_orderstatus}": r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    assert {r.table_name: r.dq_tgt_num for r in rows.collect() if r.dq_column == "count(*)"} == {k: v for k, v in want.items() if k[-1] in "FOP"}
    assert {r.table_filter for r in rows.collect()} == {"o_orderstatus = :s"}
