"""Suites over one table with different filters share one scan."""

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.plans.suite import _single_call

from conftest import SF001

CTX = RunContext.create("2001-08-01 06:00:00", now="2001-08-01 06:30:00", dq_key=3, env="TEST")
KEY = ["table_filter", "check_id", "dq_column", "dq_tgt_value", "dq_src_value", "is_pass", "dq_tgt_num"]


def _specs():
    return [CheckSpec.make("empty_null", columns=["o_orderpriority", "o_custkey"]),
            CheckSpec.make("up_to_date", columns=["o_orderdate"]),
            CheckSpec.make("trending", columns=["count(*)", "max(o_custkey) - min(o_custkey)",
                                                "count(DISTINCT o_custkey)"]),
            CheckSpec.make("missing_dates", columns=["o_orderdate"]),
            CheckSpec.make("compare_to_source", source=TableRef("a.b.c", orders_src[0]), threshold="1")]


orders_src = []


def test_single_call():
    assert _single_call("count(*)") and _single_call("sum(CASE WHEN a = ')' THEN 1 END)")
    assert not _single_call("sum(a) / count(b)") and not _single_call("a + 1")
    assert not _single_call("count(*) OVER ()")


def test_filters_share_one_scan(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    orders_src[:] = [orders.limit(10)]
    filters = [None, "o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'none'"]
    suites = [Suite(TableRef("t.s.orders", orders, f), _specs()) for f in filters]
    fused = {tuple(r[k] for k in KEY) for r in run_suite(spark, suites, CTX).collect()}
    alone = set()
    for f in filters:
        alone |= {tuple(r[k] for k in KEY)
                  for r in run_suite(spark, Suite(TableRef("t.s.orders", orders, f), _specs()), CTX).collect()}
    assert fused == alone
    empty = {r[2]: r for r in fused if r[0] == "o_orderstatus = 'none'"}
    assert empty["o_orderpriority"][3] is None            # empty_null over no rows: NULL
    assert empty["count(*)"][3] == "0"
    assert empty["o_orderdate"][3] in ("90", None)


def test_separate_reads_of_one_table_share(spark):
    from tableguard.plans.suite import _shared_scans
    a = spark.read.parquet(f"{SF001}/orders.parquet")
    b = spark.read.parquet(f"{SF001}/orders.parquet")
    c = spark.read.parquet(f"{SF001}/lineitem.parquet")
    specs = [CheckSpec.make("empty_null", columns=["o_custkey"])]
    suites = [Suite(TableRef("t.s.o", a, "o_orderstatus = 'F'"), specs),
              Suite(TableRef("t.s.o", b, "o_orderstatus = 'O'"), specs),
              Suite(TableRef("t.s.l", c, "l_quantity > 1"), [CheckSpec.make("empty_null", columns=["l_tax"])])]
    shared = _shared_scans(suites)
    assert id(suites[0]) in shared and shared[id(suites[0])] is shared[id(suites[1])]
    assert id(suites[2]) not in shared


def test_filters_share_grouped_metrics(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    orders_src[:] = [orders.limit(10)]

    def specs():
        return [CheckSpec.make("missing_dates", columns=["o_orderdate"]),
                CheckSpec.make("day_to_day", columns=["count(*)", "sum(o_totalprice)"],
                               group_by="CAST(o_orderdate AS DATE)", num_days=6, threshold="0.5"),
                CheckSpec.make("day_to_day", columns=["max(o_custkey) - min(o_custkey)"],
                               group_by="o_orderpriority", num_days=3)]
    filters = [None, "o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'none'"]
    fused = {tuple(r[k] for k in KEY)
             for r in run_suite(spark, [Suite(TableRef("t.s.o", orders, f), specs()) for f in filters],
                                CTX).collect()}
    alone = set()
    for f in filters:
        alone |= {tuple(r[k] for k in KEY)
                  for r in run_suite(spark, Suite(TableRef("t.s.o", orders, f), specs()), CTX).collect()}
    assert fused == alone


def test_filters_share_unique_counts(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")

    def specs():
        return [CheckSpec.make("unique", columns=["o_orderkey", "o_custkey, o_orderdate", "o_orderpriority"])]
    filters = [None, "o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'none'"]
    fused_df = run_suite(spark, [Suite(TableRef("t.s.o", orders, f), specs()) for f in filters], CTX)
    fused = {tuple(r[k] for k in KEY) for r in fused_df.collect()}
    alone = set()
    for f in filters:
        alone |= {tuple(r[k] for k in KEY)
                  for r in run_suite(spark, Suite(TableRef("t.s.o", orders, f), specs()), CTX).collect()}
    assert fused == alone
    none = {r[2]: r for r in fused if r[0] == "o_orderstatus = 'none'"}
    assert none["o_orderkey"][3] == "0" and none["o_orderkey"][5] is True


def test_compound_metric_over_empty_filter_keeps_empty_input_value(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    specs = lambda: [CheckSpec.make("trending", columns=["count(*) * 2", "sum(o_totalprice) / count(*)"])]
    filters = ["o_orderstatus = 'F'", "o_orderstatus = 'none'"]
    out = {(r["table_filter"], r["dq_column"]): r["dq_tgt_value"]
           for r in run_suite(spark, [Suite(TableRef("t.s.o", orders, f), specs()) for f in filters],
                              CTX).collect()}
    n_f = orders.where("o_orderstatus = 'F'").count()
    assert out[("o_orderstatus = 'F'", "count(*) * 2")] == str(2 * n_f)
    assert out[("o_orderstatus = 'none'", "count(*) * 2")] == "0"
    assert out[("o_orderstatus = 'none'", "sum(o_totalprice) / count(*)")] is None
