"""The whole job, composed from the public API: wait -> load -> check -> gate."""

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
from tableguard.plans.observe import ObservedChecks
from tableguard.plans.suite import expected_rules


def _run_day(spark, scratch, day: dt.date, results_path: str):
    ctx = RunContext.create(f"{day.isoformat()} 05:00:00", now=f"{day.isoformat()} 05:10:00",
                            dq_key=int(day.strftime("%Y%m%d")), env="TEST", unix_user="job")
    # 1. upstream readiness from the task log
    log = E._task_log(spark, SF001)
    status = FR.readiness(spark, FR.task_freshness(log, ["etl.purchase"], dt.date(2024, 1, 30)),
                          ["etl.purchase"], dt.date(2024, 1, 30))
    assert FR.ready_gate(status)["proceed"]
    # 2. load: this day's orders appended into the run's partition, scalar checks observed
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    src = orders.where(F.to_date("o_orderdate") <= F.lit(day))
    load_specs = [CheckSpec.make("empty_null", columns=["o_custkey"]),
                  CheckSpec.make("trending_load", columns=["count(*)"], threshold="0.5")]
    history = R.read_results(spark, results_path) if os.path.exists(results_path) else None
    oc = ObservedChecks("shop.core.orders", load_specs, ctx)
    rows = L.with_audit(L.project(src, E.ORDER_COLUMNS), ctx).drop(*L.DEFAULT_PARTITION_KEYS)
    L.write_partition(spark, "e2e_orders", oc.attach(rows), ctx)
    # 3. the check suite over the loaded table
    table = TableRef("shop.core.orders", spark.table("e2e_orders"))
    suite = Suite(table, [CheckSpec.make("unique", columns=["o_orderkey"], stop_on_failure=True),
                          CheckSpec.make("up_to_date", columns=["o_orderdate"])])
    out = oc.results(spark, history).unionByName(run_suite(spark, suite, ctx, history))
    R.append_results(out, results_path)
    # 4. report; the caller gates after all rules ran
    res = R.read_results(spark, results_path)
    exp = expected_rules(spark, [suite, Suite(table, load_specs)], ctx)
    return {r["test_name"]: r for r in R.summary(res, ctx.dq_key, exp).collect()}, ctx, exp


def test_two_daily_runs(spark, scratch):
    L.create_table(spark, "e2e_orders", E.ORDER_COLUMNS, location=os.path.join(scratch, "e2e_orders"))
    results_path = os.path.join(scratch, "dq_results")
    day1, ctx1, exp1 = _run_day(spark, scratch, dt.date(2001, 7, 30), results_path)
    R.stop_gate(R.read_results(spark, results_path), ctx1.dq_key, exp1)   # passes
    assert day1["unique for o_orderkey"]["result"] == "PASS"
    assert day1["trending for count(*)"]["result"] == "PASS"      # first run: no baseline
    assert day1["up_to_date for o_orderdate"]["result"] == "PASS"
    day2, ctx2, exp2 = _run_day(spark, scratch, dt.date(2001, 7, 31), results_path)
    # the second run compares with the first run's load count
    n1 = spark.read.parquet(f"{SF001}/orders.parquet").where("to_date(o_orderdate) <= DATE'2001-07-30'").count()
    assert f"src={n1};" in day2["trending for count(*)"]["detail"]
    assert spark.table("e2e_orders").count() == \
        spark.read.parquet(f"{SF001}/orders.parquet").where("to_date(o_orderdate) <= DATE'2001-07-30'").count() + \
        spark.read.parquet(f"{SF001}/orders.parquet").where("to_date(o_orderdate) <= DATE'2001-07-31'").count()
    # the second load appended into its own partition: keys repeat across runs, the gate stops
    assert day2["unique for o_orderkey"]["result"] == "FAIL"
    with pytest.raises(R.StopOnFailure):
        R.stop_gate(R.read_results(spark, results_path), ctx2.dq_key, exp2)
