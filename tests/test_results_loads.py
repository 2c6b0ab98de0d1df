"""Result table I/O, report gates, loads (writers and properties), readiness."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.operators import freshness as FR
from tableguard.operators import loads as L
from tableguard.operators import results as R

CTX = RunContext.create("2024-03-31 06:00:00", now="2024-03-31 06:10:00", dq_key=42, env="TEST",
                        unix_user="tester")


def test_results_append_read_and_evolve(spark, scratch):
    path = os.path.join(scratch, "dq_results")
    suite = Suite(TableRef("d.s.t", spark.range(10)),
                  [CheckSpec.make("unique", columns=["id"]), CheckSpec.make("trending", columns=["count(*)"])])
    R.append_results(run_suite(spark, suite, CTX), path)
    back = R.read_results(spark, path)
    assert back.columns == R.RESULT_COLUMNS and back.count() == 2
    files = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) == 1  # one small file per suite append, not one per plan branch
    # Next run: history snapshot read before the append; the baseline is the first run.
    ctx2 = CTX.with_(run_hour=dt.datetime(2024, 4, 1, 6), dq_key=43, as_of=dt.date(2024, 4, 1))
    suite2 = Suite(TableRef("d.s.t", spark.range(12)), [CheckSpec.make("trending", columns=["count(*)"],
                                                                       threshold="0.1")])
    r = run_suite(spark, suite2, ctx2, R.read_results(spark, path)).first()
    assert r["dq_src_value"] == "10" and not r["is_pass"]
    # An older layout without the later columns reads back conformed.
    old = os.path.join(scratch, "old_layout")
    run_suite(spark, suite, CTX).drop("is_trial", "check_id", "dq_tgt_num").write \
        .partitionBy("dq_run_date").parquet(old)
    o = R.read_results(spark, old)
    assert o.columns == R.RESULT_COLUMNS
    assert {r["check_id"] for r in o.collect()} == {"unique", "trending"}
    assert all(r["is_trial"] is None for r in o.collect())


def test_results_table_create_and_insert(spark, scratch):
    R.create_results(spark, "dq_results_tbl", os.path.join(scratch, "tbl"))
    out = run_suite(spark, Suite(TableRef("d.s.t", spark.range(3)), [CheckSpec.make("unique", columns=["id"])]), CTX)
    R.append_results(out, table="dq_results_tbl")
    R.append_results(out, table="dq_results_tbl")
    assert spark.table("dq_results_tbl").count() == 2


def test_stop_gate_raises_after_all_checks(spark):
    specs = [CheckSpec.make("unique", columns=["k"], stop_on_failure=True),
             CheckSpec.make("empty_null", columns=["k"])]
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out = run_suite(spark, Suite(TableRef("d.s.t", df), specs), CTX)
    assert out.count() == 2  # every rule ran
    with pytest.raises(R.StopOnFailure):
        R.stop_gate(out, CTX.dq_key)
    ok = run_suite(spark, Suite(TableRef("d.s.t", df), specs[1:]), CTX)
    R.stop_gate(ok, CTX.dq_key)  # failing, but not a stop rule


def test_rollup_no_rows_fails_and_summary(spark):
    summ = {r["test_name"]: r for r in E.q_summary(spark, SF001).collect()}
    assert summ["day_to_day for count(*)"]["result"] == "FAIL"
    assert summ["compare_to_source for count(*)"]["result"] == "PASS"
    assert "orders_without_customer" in summ


def _loaded(spark, scratch, name, df, parts=None):
    L.create_table(spark, name, E.ORDER_COLUMNS, parts, os.path.join(scratch, name))
    L.write_overwrite(spark, name, df)


def test_create_table_schema(spark, scratch):
    L.create_table(spark, "t_schema", [{"a": {"type": "float", "pii": True}}, {"b": {"type": "timestamp"}}],
                   location=os.path.join(scratch, "t_schema"))
    t = spark.table("t_schema")
    assert [f.dataType.simpleString() for f in t.schema.fields][:2] == ["double", "timestamp_ntz"]
    assert t.columns[-4:] == L.DEFAULT_PARTITION_KEYS
    with pytest.raises(KeyError):
        L.table_schema([("x", "decimal")])


def test_append_partition_writer_clears_even_when_empty(spark, scratch):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    _loaded(spark, scratch, "t_append", L.overwrite(orders.limit(100), E.ORDER_COLUMNS, E.LOAD_CTX))
    other = L.overwrite(orders.limit(7), E.ORDER_COLUMNS, E.LOAD_OLD_CTX)
    L.write_partition(spark, "t_append", other.drop(*L.DEFAULT_PARTITION_KEYS), E.LOAD_OLD_CTX)
    assert spark.table("t_append").count() == 107
    # Appending twice for the same run = once.
    src = L.with_audit(L.project(orders.limit(5), E.ORDER_COLUMNS), E.LOAD_CTX)
    L.write_partition(spark, "t_append", src, E.LOAD_CTX)
    L.write_partition(spark, "t_append", src, E.LOAD_CTX)
    assert spark.table("t_append").count() == 12
    # An empty source empties the run's partition and leaves the others.
    L.write_partition(spark, "t_append", src.limit(0), E.LOAD_CTX)
    assert spark.table("t_append").count() == 7


def test_upsert_writer_and_properties(spark, scratch):
    tgt = E._loaded_orders(spark, SF001)
    src = E._new_orders(spark, SF001)
    out = L.upsert(tgt, src, ["o_orderkey"], E.ORDER_COLUMNS, E.LOAD_CTX)
    kept = tgt.join(src.select("o_orderkey"), "o_orderkey", "left_anti").count()
    assert out.count() == src.count() + kept
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    _loaded(spark, scratch, "t_upsert", tgt)
    cur = spark.table("t_upsert")
    new = L.upsert(cur, src, ["o_orderkey"], E.ORDER_COLUMNS, E.LOAD_CTX)
    L.write_version(spark, "t_upsert", new, os.path.join(scratch, "t_upsert_v2"))
    assert spark.table("t_upsert").count() == out.count()
    assert spark.table("t_upsert").where("o_orderstatus = 'U'").count() == src.count()


def test_upsert_null_key_raises_and_duplicates_kept(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    tgt = L.with_audit(tgt, E.LOAD_OLD_CTX)
    cols = [("k", "bigint"), ("v", "string")]
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, v string")
    assert sorted(r["v"] for r in L.upsert(tgt, dup, "k", cols, E.LOAD_CTX).collect()) == ["b", "x", "y"]
    bad = spark.createDataFrame([(None, "x")], "k bigint, v string")
    with pytest.raises(Exception, match="NULL primary key"):
        L.upsert(tgt, bad, "k", cols, E.LOAD_CTX).collect()
    with pytest.raises(L.LoadConfigError):
        L.load(tgt, dup, "update", cols, E.LOAD_CTX)
    with pytest.raises(L.LoadConfigError):
        L.load(tgt, dup, "merge", cols, E.LOAD_CTX)
    with pytest.raises(L.LoadConfigError):
        L.load(tgt, dup, None, cols, E.LOAD_CTX)


def test_strict_not_in_drops_null_key_rows(spark):
    cols = [("k", "bigint"), ("v", "string")]
    tgt = L.with_audit(spark.createDataFrame([(1, "a"), (None, "n")], "k bigint, v string"), E.LOAD_OLD_CTX)
    src = spark.createDataFrame([(2, "x")], "k bigint, v string")
    assert L.upsert(tgt, src, "k", cols, E.LOAD_CTX).count() == 3
    assert L.upsert(tgt, src, "k", cols, E.LOAD_CTX, strict_not_in=True).count() == 2
    assert L.upsert(tgt, src.limit(0), "k", cols, E.LOAD_CTX, strict_not_in=True).count() == 2


def test_stage_keeps_null_predicate_rows(spark):
    stg = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    out = L.stage(stg, spark.createDataFrame([(9,)], "a int"), "a > 2")
    assert sorted((r["a"] is None, r["a"]) for r in out.collect()) == [(False, 1), (False, 9), (True, None)]
    assert L.stage(stg, stg.limit(0)).count() == 3


def test_tmp_steps(spark):
    df = spark.range(5)
    L.tmp_step(df, "tmp_a")
    L.tmp_step(df, "tmp_b", materialize="persist")
    L.tmp_step(df, "tmp_c", materialize="checkpoint")
    assert spark.table("tmp_c").count() == 5
    L.drop_tmp(spark, ["tmp_a", "tmp_b", "tmp_c"])
    assert not spark.catalog.tableExists("tmp_b")


def test_readiness_and_gate(spark):
    st = {(r["kind"], r["name"]): r["status"] for r in E.q_readiness(spark, SF001).collect()}
    assert st[("table", "web.refund")] == "MISSING"
    assert st[("table", "web.click")] == "READY"
    assert st[("task", "etl.click")] == "WAITING"
    with pytest.raises(FR.UpstreamMissing):
        FR.ready_gate(E.q_readiness(spark, SF001))
    tasks = FR.readiness(spark, FR.task_freshness(E._task_log(spark, SF001), E.WANTED_TASKS,
                                                  dt.date(2024, 1, 31)), E.WANTED_TASKS, dt.date(2024, 1, 31))
    g = FR.ready_gate(tasks)
    assert g == {"ready": 0, "waiting": 3, "proceed": False}


def test_fused_suite_scans(spark):
    """Scalar rules share one scan; missing_dates and day_to_day on the same
    day key share one groupBy; unique reads only its column."""
    import re
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        o = spark.read.parquet(f"{SF001}/orders.parquet")
        specs = [CheckSpec.make("empty_null", columns=["o_orderstatus", "o_custkey"]),
                 CheckSpec.make("up_to_date", columns=["o_orderdate"]),
                 CheckSpec.make("trending", columns=["count(*)", "sum(o_totalprice)"]),
                 CheckSpec.make("std_dev", columns=["count(*)"]),
                 CheckSpec.make("unique", columns=["o_orderkey"]),
                 CheckSpec.make("missing_dates", columns=["o_orderdate"]),
                 CheckSpec.make("day_to_day", columns=["count(*)"], group_by="to_date(o_orderdate)", num_days=7)]
        df = run_suite(spark, Suite(TableRef("a.b.orders", o), specs), E.OR_CTX)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scans = set()
        for i, line in enumerate(lines):
            if "FileScan parquet" in line:
                # the exchange directly above identifies the (possibly shared) subplan
                above = [l for l in lines[:i] if "Exchange" in l][-1]
                scans.add(re.search(r"plan_id=(\d+)", above).group(1))
        assert len(scans) == 3, plan
        assert "NestedLoopJoin" not in plan and "Expand" not in plan
        assert df.count() == 2 + 1 + 2 + 1 + 1 + 1 + 7
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_custom_without_rows_fails_in_report(spark):
    from tableguard.plans.suite import expected_rules
    suite = Suite(TableRef("d.s.t", spark.range(3)),
                  [CheckSpec.make("unique", columns=["id"]),
                   CheckSpec.custom("empty_custom", "SELECT 1 AS tgt_value, 1 AS src_value, 0 AS result WHERE false",
                                    stop_on_failure=True)])
    out = run_suite(spark, suite, CTX)
    exp = expected_rules(spark, suite, CTX)
    summ = {r["test_name"]: r["result"] for r in R.summary(out, CTX.dq_key, exp).collect()}
    assert summ == {"unique for id": "PASS", "empty_custom": "FAIL"}
    assert R.summary(out, CTX.dq_key).count() == 1
    with pytest.raises(R.StopOnFailure):
        R.stop_gate(out, CTX.dq_key, exp)
    R.stop_gate(out, CTX.dq_key)


def test_filter_parameters(spark):
    t = TableRef("d.s.t", spark.range(10), "id >= :lo AND id < :hi", args={"lo": 3, "hi": 7})
    r = run_suite(spark, Suite(t, [CheckSpec.make("unique", columns=["id"])]), CTX).first()
    assert r["dq_src_value"] == "4" and r["table_filter"] == "id >= :lo AND id < :hi"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == R.RESULT_COLUMNS and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_observed_checks_during_load_write(spark, scratch):
    from tableguard.plans.observe import ObservedChecks
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    specs = [CheckSpec.make("empty_null", columns=["o_orderstatus", "o_custkey"]),
             CheckSpec.make("up_to_date", columns=["o_orderdate"]),
             CheckSpec.make("trending", columns=["count(*)", "sum(o_totalprice)"], threshold="0.1")]
    ctx = E.LOAD_CTX
    rows = L.overwrite(orders, E.ORDER_COLUMNS, ctx)
    oc = ObservedChecks("tpch.sf.orders", specs, ctx)
    rows.transform(oc.attach).write.mode("overwrite").parquet(os.path.join(scratch, "loaded"))
    observed = {(r["check_id"], r["dq_column"]): r for r in oc.results(spark).collect()}
    scanned = {(r["check_id"], r["dq_column"]): r
               for r in run_suite(spark, Suite(TableRef("tpch.sf.orders", rows), specs), ctx).collect()}
    assert observed.keys() == scanned.keys()
    for k in observed:
        for c in ("dq_tgt_value", "dq_src_value", "is_pass", "dq_tgt_num"):
            assert observed[k][c] == scanned[k][c], (k, c)
    with pytest.raises(Exception):
        ObservedChecks("a.b.c", [CheckSpec.make("unique", columns=["x"])], ctx)


def test_isolated_run_and_compare_range(spark, scratch):
    path = R.scratch_results_path(spark, CTX.dq_key, fallback=scratch)
    assert path.endswith(f"tableguard-scratch/{CTX.dq_key}")
    spec = CheckSpec.make("compare_to_source", threshold="0.1,0.5", source=TableRef("a.b.s", spark.range(8)))
    assert (spec.threshold.text, spec.threshold.value, spec.threshold.mode) == ("0.5", 0.5, "absolute")
    out = run_suite(spark, Suite(TableRef("a.b.t", spark.range(10)), [spec]), CTX)
    R.append_results(out, path)
    r = R.read_results(spark, path).first()
    assert (r["dq_threshold"], r["is_pass"]) == ("0.5", True)


def test_date_column_shares_day_groupby(spark):
    import re
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = spark.read.parquet(f"{SF001}/events.parquet").selectExpr("CAST(ts AS DATE) AS d", "value")
        specs = [CheckSpec.make("missing_dates", columns=["d"]),
                 CheckSpec.make("day_to_day", columns=["sum(value)"], group_by="d", num_days=3)]
        df = run_suite(spark, Suite(TableRef("a.b.ev", ev), specs), CTX)
        plan = df._jdf.queryExecution().executedPlan().toString()
        groupings = set(re.findall(r"Exchange hashpartitioning\(([^,]+)#", plan))
        assert len(groupings) == 1, groupings
        assert df.count() == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_upsert_rewrites_only_touched_partitions(spark, scratch):
    from tableguard.context import RunContext
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    ctx_a = RunContext.create("2000-01-01 01:00:00", now="2000-01-01 01:00:00", dq_key=1, unix_user="a")
    ctx_b = RunContext.create("2000-02-01 01:00:00", now="2000-02-01 01:00:00", dq_key=2, unix_user="b")
    ctx_c = RunContext.create("2000-03-01 01:00:00", now="2000-03-01 01:00:00", dq_key=3, unix_user="c")
    a = L.overwrite(orders.where("o_orderdate < TIMESTAMP'1997-01-01 00:00:00'"), E.ORDER_COLUMNS, ctx_a)
    b = L.overwrite(orders.where("o_orderdate >= TIMESTAMP'1997-01-01 00:00:00' AND "
                                 "o_orderdate < TIMESTAMP'1999-01-01 00:00:00'"), E.ORDER_COLUMNS, ctx_b)
    c = L.overwrite(orders.where("o_orderdate >= TIMESTAMP'1999-01-01 00:00:00'"), E.ORDER_COLUMNS, ctx_c)
    L.create_table(spark, "t_sel", E.ORDER_COLUMNS, location=os.path.join(scratch, "t_sel"))
    L.write_overwrite(spark, "t_sel", a.unionByName(b).unionByName(c))
    before = {tuple(r) for r in spark.table("t_sel").collect()}
    # the source replaces every row of partition b and ten rows of partition c
    src = (orders.where("o_orderdate >= TIMESTAMP'1997-01-01 00:00:00' AND "
                        "o_orderdate < TIMESTAMP'1999-01-01 00:00:00'")
           .unionByName(orders.where("o_orderdate >= TIMESTAMP'1999-01-01 00:00:00'").orderBy("o_orderkey").limit(10))
           .withColumn("o_orderstatus", F.lit("U")))
    tgt_snapshot = spark.createDataFrame(list(before), spark.table("t_sel").schema)
    expected = {tuple(r) for r in L.upsert(tgt_snapshot, src, "o_orderkey", E.ORDER_COLUMNS, E.LOAD_CTX,
                                           restamp=False).select(*spark.table("t_sel").columns).collect()}
    a_dir = os.path.join(scratch, "t_sel", "dl_partition_year=2000", "dl_partition_month=01")
    a_files = sorted(os.listdir(os.path.join(a_dir, "dl_partition_day=01", "dl_partition_hour=01")))
    touched = L.write_upsert_partitions(spark, "t_sel", src, "o_orderkey", E.ORDER_COLUMNS, E.LOAD_CTX,
                                        os.path.join(scratch, "stage1"))
    assert touched == 3
    after = {tuple(r) for r in spark.table("t_sel").collect()}
    if after != expected:
        import collections
        extra = collections.Counter(r[-4:] for r in after - expected)
        missing = collections.Counter(r[-4:] for r in expected - after)
        raise AssertionError(f"extra {dict(extra)} missing {dict(missing)} "
                             f"n_after={len(after)} n_exp={len(expected)}")
    # partition a was not rewritten; partition b (fully replaced) holds no files any more
    assert sorted(os.listdir(os.path.join(a_dir, "dl_partition_day=01", "dl_partition_hour=01"))) == a_files
    b_dir = os.path.join(scratch, "t_sel", "dl_partition_year=2000", "dl_partition_month=02")
    left = [f for _, _, fs in os.walk(b_dir) for f in fs if f.endswith(".parquet")]
    assert left == []
    spark.sql("ALTER TABLE t_sel RECOVER PARTITIONS")
    spark.catalog.refreshTable("t_sel")
    assert {tuple(r) for r in spark.table("t_sel").collect()} == expected


def test_evolve_results_table(spark, scratch):
    old_fields = [f for f in R.RESULT_SCHEMA.fields if f.name not in ("is_trial", "check_id", "dq_tgt_num")]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in old_fields)
    spark.sql(f"CREATE TABLE dq_old ({cols}) USING parquet PARTITIONED BY (dq_run_date) "
              f"LOCATION '{os.path.join(scratch, 'dq_old')}'")
    out = run_suite(spark, Suite(TableRef("d.s.t", spark.range(3)), [CheckSpec.make("unique", columns=["id"])]), CTX)
    out.select(*[f.name for f in old_fields]).write.insertInto("dq_old")
    assert R.evolve_results(spark, "dq_old") == ["is_trial", "check_id", "dq_tgt_num"]
    assert R.evolve_results(spark, "dq_old") == []
    R.append_results(out, table="dq_old")
    rows = spark.table("dq_old").select(*R.RESULT_COLUMNS).collect()
    assert len(rows) == 2 and sorted(str(r["is_trial"]) for r in rows) == ["False", "None"]


def test_upsert_partitions_many_touched_path(spark, scratch):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    rows = (L.with_audit(L.project(orders, E.ORDER_COLUMNS), E.LOAD_OLD_CTX)
            .withColumn("dl_partition_month", F.date_format("o_orderdate", "MM")))
    L.create_table(spark, "t_many", E.ORDER_COLUMNS, location=os.path.join(scratch, "t_many"))
    L.write_overwrite(spark, "t_many", rows)
    snap = spark.createDataFrame(spark.table("t_many").collect(), spark.table("t_many").schema)
    src = orders.where("month(o_orderdate) IN (3, 4)").withColumn("o_orderstatus", F.lit("U"))
    expected = {tuple(r) for r in L.upsert(snap, src, "o_orderkey", E.ORDER_COLUMNS, E.LOAD_CTX,
                                           restamp=False).select(*snap.columns).collect()}
    touched = L.write_upsert_partitions(spark, "t_many", src, "o_orderkey", E.ORDER_COLUMNS, E.LOAD_CTX,
                                        os.path.join(scratch, "stage_many"))
    assert touched == 3
    assert {tuple(r) for r in spark.table("t_many").collect()} == expected


def test_partition_writer_null_moved_and_emptied_partitions(spark, scratch):
    spark.sql("CREATE TABLE t_null (id BIGINT, v STRING, dw_create_ts TIMESTAMP_NTZ, dw_create_user STRING, "
              "dw_modified_ts TIMESTAMP_NTZ, dw_modified_user STRING, dl_partition_year STRING, dl_partition_month STRING, "
              "dl_partition_day STRING, dl_partition_hour STRING, reg STRING) USING parquet PARTITIONED BY (reg) "
              f"LOCATION '{os.path.join(scratch, 't_null')}'")
    COLS = [("id", "bigint"), ("v", "string"), ("reg", "string")]
    old = L.with_audit(spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x"), (4, "d", "y")],
                                             "id long, v string, reg string"), E.LOAD_OLD_CTX)
    old.select(*spark.table("t_null").columns).write.insertInto("t_null")
    snap = spark.table("t_null").collect()
    src = spark.createDataFrame([(1, "NEW", "x"), (4, "moved", None)], "id long, v string, reg string")
    frozen = spark.createDataFrame(snap, spark.table("t_null").schema)
    expected = sorted((r.id, r.v, r.reg or "") for r in
                      L.upsert(frozen, src, "id", COLS, E.LOAD_CTX, restamp=False).collect())
    assert L.write_upsert_partitions(spark, "t_null", src, "id", COLS, E.LOAD_CTX,
                                     os.path.join(scratch, "stage_null")) == 3
    assert sorted((r.id, r.v, r.reg or "") for r in spark.table("t_null").collect()) == expected
    src = spark.createDataFrame([(2, "gone", "z"), (4, "gone", "z")], "id long, v string, reg string")
    L.write_upsert_partitions(spark, "t_null", src, "id", COLS, E.LOAD_CTX,
                              os.path.join(scratch, "stage_null2"))
    assert sorted((r.id, r.reg) for r in spark.table("t_null").collect()) == [(1, "x"), (2, "z"), (3, "x"), (4, "z")]


def test_failing_segment_and_other_table_stay_visible(spark):
    """Rows of one run written at the same time: a failing one is what the gate sees."""
    specs = [CheckSpec.make("unique", columns=["id"], stop_on_failure=True)]
    good, bad = spark.range(3), spark.createDataFrame([(1,), (1,)], "id long")
    for names in (("d.s1.a", "d.s2.a"), ("d.s.a", "d.s.b")):
        for first, second in ((good, bad), (bad, good)):
            rows = run_suite(spark, Suite(TableRef(names[0], first), specs), CTX).unionByName(
                run_suite(spark, Suite(TableRef(names[1], second), specs), CTX))
            assert R.stop_gate_rows(rows).count() == 1
            assert R.verdicts(rows).count() == 2


def test_value_beyond_bigint_does_not_stop_the_suite(spark):
    df = spark.createDataFrame([(1, 1e19)], "id long, v double")
    specs = [CheckSpec.make("std_dev", columns=["sum(v)"], threshold="+2"), CheckSpec.make("unique", columns=["id"])]
    first = run_suite(spark, Suite(TableRef("d.s.big", df), specs), CTX)
    assert first.count() == 2
    again = run_suite(spark, Suite(TableRef("d.s.big", df), specs), CTX, first)
    assert {r.dq_name for r in again.collect()} == {"std_dev", "unique"}
