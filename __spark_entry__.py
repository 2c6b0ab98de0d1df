"""

Every query binds tableguard operators to the driver's tables.  Runs use a
fixed ``RunContext`` (run hour, timestamps, key, users), so results are
reproducible and comparable with the DuckDB oracle, which is written
directly from the check semantics (not generated from the Spark plans).

History for trending / std_dev is derived from the tables themselves: each
day before ``as_of`` is an earlier run at 06:00 that recorded that day's
aggregate (``sources.tables.daily_history``).
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.operators import freshness as FR
from tableguard.operators import history as H
from tableguard.operators import loads as L
from tableguard.operators import reports as K
from tableguard.operators import results as R
from tableguard.operators.partials import KeyRanges
from tableguard.plans.file_statistics import StatisticsChecks
from tableguard.plans.incremental import IncrementalChecks
from tableguard.plans.isolated import isolated_run
from tableguard.scratch import scratch_path
from tableguard.sources.tables import daily_history, read_table

SMOKE_DIR = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------
# Run contexts and bindings
# ---------------------------------------------------------------------------
ENV, DB_USER, UNIX_USER = "TEST", "dq_user", "etl_user"

LI_ASOF = dt.date(2001, 7, 31)
LI_CTX = RunContext.create("2001-07-31 06:00:00", now="2001-07-31 06:30:00", dq_key=996559200,
                           env=ENV, db_user=DB_USER, unix_user=UNIX_USER)
EV_CTX = RunContext.create("2024-01-30 06:00:00", now="2024-01-30 06:30:00", dq_key=1706594400,
                           env=ENV, db_user=DB_USER, unix_user=UNIX_USER)
EV_STALE_CTX = EV_CTX.with_(as_of=dt.date(2024, 1, 31))
OR_CTX = RunContext.create("2001-08-01 06:00:00", now="2001-08-01 06:30:00", dq_key=996645600,
                           env=ENV, db_user=DB_USER, unix_user=UNIX_USER)
LOAD_OLD_CTX = RunContext.create("2001-01-01 03:00:00", now="2001-01-01 03:15:00", dq_key=978318000,
                                 env=ENV, unix_user="old_loader")
LOAD_CTX = RunContext.create("2001-08-02 07:00:00", now="2001-08-02 07:05:00", dq_key=996735600,
                             env=ENV, unix_user=UNIX_USER)

LI_NAME = "tpch.sf.lineitem"
LI_DAY_FILTER = "CAST(l_shipdate AS DATE) = DATE '2001-07-31'"
FLAG_COLUMNS = [f"sum(CASE WHEN l_returnflag = '{f}' THEN 1 ELSE 0 END)" for f in ("A", "N", "R")]


_READS: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One DataFrame per (session, table): the file listing happens once.
    The test tables are read-only, so the listing stays valid."""
    key = (id(spark), d, name)
    hit = _READS.get(key)
    if hit is None or hit[0] is not spark:
        # The session is kept in the entry, so its id cannot be reused by another one.
        _READS[key] = hit = (spark, read_table(spark, d, name))
    return hit[1]


def _li_target(spark, d) -> TableRef:
    return TableRef(LI_NAME, _t(spark, d, "lineitem"), LI_DAY_FILTER)


def _li_history(spark, d, dq_name: str, columns=("count(*)",)) -> DataFrame:
    return daily_history(_t(spark, d, "lineitem"), "l_shipdate", {c: c for c in columns},
                         LI_NAME, dq_name, before=LI_ASOF, env=ENV)


def _suite(spark, target: TableRef, specs, ctx, history=None) -> DataFrame:
    return run_suite(spark, Suite(target, list(specs)), ctx, history)


# -- trending ---------------------------------------------------------------
TRENDING = {
    "trending_absolute": dict(threshold="0.1"),
    "trending_upward": dict(threshold="+0.2"),
    "trending_downward": dict(threshold="-0.2"),
    "trending_range": dict(threshold="0.1,0.5"),
    "trending_day": dict(threshold="0.3", compare_type="day"),
    "trending_week": dict(threshold="0.3", compare_type="week"),
    "trending_month": dict(threshold="0.3", compare_type="month"),
    "trending_year": dict(threshold="0.3", compare_type="year"),
}


def _trending_query(name):
    def q(spark, d):
        spec = CheckSpec.make(name, columns=["count(*)"], description="lineitem rows shipped",
                              **TRENDING[name])
        return _suite(spark, _li_target(spark, d), [spec], LI_CTX, _li_history(spark, d, "trending"))
    return q


def q_trending_first_run(spark, d):
    spec = CheckSpec.make("trending_first_run", columns=["sum(l_quantity)"], threshold="0.1",
                          description="no earlier run")
    return _suite(spark, _li_target(spark, d), [spec], LI_CTX, _li_history(spark, d, "trending"))


DISTINCT_METRICS = ["count(DISTINCT l_orderkey)", "count(DISTINCT l_partkey)", "count(DISTINCT l_suppkey)",
                    "sum(l_quantity)"]


def q_trending_distinct(spark, d):
    spec = CheckSpec.make("trending_distinct", columns=DISTINCT_METRICS, threshold="0.1", description="no earlier run")
    return _suite(spark, _li_target(spark, d), [spec], LI_CTX, _li_history(spark, d, "trending"))


STORED_COLUMNS = ["count(*)", "count(DISTINCT user_id)", "max(user_id)"]


def _stored_events_history(spark, d) -> R.StoredResults:
    """A written result table, partitioned by run date: daily runs over events.  ``max(user_id)`` was last
    recorded twelve days before the run."""
    events = _t(spark, d, "events")
    before = EV_CTX.as_of
    frames = [daily_history(events, "ts", {c: c for c in STORED_COLUMNS[:2]}, "web.analytics.events", "trending", before=before, env=ENV),
              daily_history(events, "ts", {STORED_COLUMNS[2]: STORED_COLUMNS[2]}, "web.analytics.events", "trending",
                            before=before - dt.timedelta(days=11), env=ENV)]
    path = scratch_path(spark, "results")
    R.append_results(frames[0].unionByName(frames[1]), path)
    return R.stored_results(spark, path)


def q_trending_stored_history(spark, d):
    """Rules that want the last run of any age beside rules that compare with a day, over a stored table."""
    specs = [CheckSpec.make("trending", columns=[*STORED_COLUMNS, "min(user_id)"], threshold="0.1"),
             CheckSpec.make("trending_day", columns=STORED_COLUMNS, threshold="0.1", compare_type="day"),
             CheckSpec.make("trending_week", columns=STORED_COLUMNS[:1], threshold="+0.5", compare_type="week")]
    target = _events_ref(spark, d, "CAST(ts AS DATE) = DATE'2024-01-30'")
    return _suite(spark, target, specs, EV_CTX, _stored_events_history(spark, d))


# -- compare_to_source --------------------------------------------------------
def _orders_ref(spark, d, filt=None) -> TableRef:
    return TableRef("tpch.sf.orders", _t(spark, d, "orders"), filt)


def _order_keys_ref(spark, d, filt=None) -> TableRef:
    return TableRef("tpch.sf.lineitem_orders",
                    _t(spark, d, "lineitem").select("l_orderkey").distinct(), filt)


def q_compare_to_source(spark, d):
    spec = CheckSpec.make("compare_to_source", threshold="0.05", source=_order_keys_ref(spark, d),
                          description="orders vs ordered keys")
    return _suite(spark, _orders_ref(spark, d), [spec], OR_CTX)


def q_compare_to_source_empty(spark, d):
    src = TableRef("tpch.sf.lineitem", _t(spark, d, "lineitem"), "l_quantity < 0")
    spec = CheckSpec.make("compare_to_source", threshold="0.05", source=src,
                          description="empty source")
    return _suite(spark, _orders_ref(spark, d), [spec], OR_CTX)


# -- day_to_day ----------------------------------------------------------------
DAY_TO_DAY = {
    "day_to_day_absolute": dict(threshold="0.05", group_by="CAST(ts AS DATE)", num_days=4),
    "day_to_day_upward": dict(threshold="+0.05", group_by="CAST(ts AS DATE)", num_days=10),
    "day_to_day_downward": dict(threshold="-0.05", group_by="CAST(ts AS DATE)", num_days=10),
    "day_to_day_range": dict(threshold="0.02,0.1", group_by="CAST(ts AS DATE)", num_days=30),
    "day_to_day_composite": dict(threshold="0.3", group_by="CAST(ts AS DATE),event_type", num_days=12),
}


def _events_ref(spark, d, filt=None) -> TableRef:
    return TableRef("web.analytics.events", _t(spark, d, "events"), filt)


def _d2d_query(name):
    def q(spark, d):
        spec = CheckSpec.make("day_to_day", columns=["count(*)"], description="events per day",
                              **DAY_TO_DAY[name])
        return _suite(spark, _events_ref(spark, d), [spec], EV_CTX)
    return q


# -- empty_null / unique / up_to_date / missing_dates --------------------------
DOC_COLUMNS = ["text", "lang", "source", "quality"]


def q_empty_null(spark, d):
    docs = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id", "left")
    spec = CheckSpec.make("empty_null", columns=DOC_COLUMNS, description="labelled documents")
    return _suite(spark, TableRef("corpus.main.documents_labels", docs), [spec], EV_CTX)


def q_unique(spark, d):
    spec = CheckSpec.make("unique", columns=["doc_id", "text"], description="document keys")
    return _suite(spark, TableRef("corpus.main.documents", _t(spark, d, "documents")), [spec], EV_CTX)


def q_unique_composite(spark, d):
    a = _suite(spark, TableRef(LI_NAME, _t(spark, d, "lineitem")),
               [CheckSpec.make("unique", columns=["l_orderkey,l_linenumber"], description="line key")],
               EV_CTX)
    b = _suite(spark, TableRef("chat.main.conversations", _t(spark, d, "conversations")),
               [CheckSpec.make("unique", columns=["conv_id,turn"], description="turn key")], EV_CTX)
    return a.unionByName(b)


def q_up_to_date(spark, d):
    spec = CheckSpec.make("up_to_date", columns=["ts"], description="events arrive daily")
    return _suite(spark, _events_ref(spark, d), [spec], EV_CTX)


def q_up_to_date_stale(spark, d):
    spec = CheckSpec.make("up_to_date", columns=["ts"], description="events arrive daily")
    return _suite(spark, _events_ref(spark, d), [spec], EV_STALE_CTX)


def q_missing_dates(spark, d):
    a = _suite(spark, _events_ref(spark, d),
               [CheckSpec.make("missing_dates", columns=["ts"], description="90 days of events")], EV_CTX)
    b = _suite(spark, TableRef(LI_NAME, _t(spark, d, "lineitem")),
               [CheckSpec.make("missing_dates", columns=["l_shipdate"], description="90 ship days")], EV_CTX)
    return a.unionByName(b)


def q_missing_dates_empty(spark, d):
    spec = CheckSpec.make("missing_dates", columns=["ts"], description="empty slice")
    return _suite(spark, _events_ref(spark, d, "value < -1e300"), [spec], EV_CTX)


# -- std_dev -------------------------------------------------------------------
STD_DEV = {
    "std_dev_absolute": dict(threshold="1"),
    "std_dev_upward": dict(threshold="+1"),
    "std_dev_downward": dict(threshold="-1"),
}


def _std_query(name):
    def q(spark, d):
        spec = CheckSpec.make(name, columns=["count(*)"], description="weekly band", **STD_DEV[name])
        return _suite(spark, _li_target(spark, d), [spec], LI_CTX, _li_history(spark, d, "std_dev"))
    return q


def q_std_dev_all_series(spark, d):
    spec = CheckSpec.make("std_dev_flags", columns=FLAG_COLUMNS, threshold="2",
                          description="per return flag")
    return _suite(spark, _li_target(spark, d), [spec], LI_CTX,
                  _li_history(spark, d, "std_dev", FLAG_COLUMNS))


def q_std_dev_seed(spark, d):
    return H.seed_std_dev(_li_history(spark, d, "trending"), "tpch", "sf", "lineitem",
                          ["count(*)"], LI_CTX)


# -- custom ----------------------------------------------------------------------
CUSTOM_SQL = ("SELECT count(*) AS tgt_value, 0 AS src_value, count(*) AS result "
              "FROM {orders} o LEFT ANTI JOIN {customer} c ON o.o_custkey = c.c_custkey")


def _custom_spec(spark, d, **kw):
    return CheckSpec.custom("orders_without_customer", CUSTOM_SQL,
                            frames={"orders": _t(spark, d, "orders"), "customer": _t(spark, d, "customer")},
                            description="every order has a customer", **kw)


def q_custom_check(spark, d):
    return _suite(spark, _orders_ref(spark, d), [_custom_spec(spark, d)], OR_CTX)


# -- suite over orders and the reports --------------------------------------------
def _orders_history(spark, d) -> DataFrame:
    return daily_history(_t(spark, d, "orders"), "o_orderdate", {"count(*)": "count(*)"},
                         "tpch.sf.orders", "trending", before=OR_CTX.as_of, env=ENV)


def orders_suite(spark, d) -> DataFrame:
    specs = [
        CheckSpec.make("compare_to_source", threshold="0.05", source=_order_keys_ref(spark, d),
                       description="orders vs ordered keys"),
        CheckSpec.make("empty_null", columns=["o_orderstatus", "o_orderpriority", "o_custkey"]),
        CheckSpec.make("unique", columns=["o_orderkey", "o_custkey,o_orderdate"], description="keys"),
        CheckSpec.make("up_to_date", columns=["o_orderdate"]),
        CheckSpec.make("missing_dates", columns=["o_orderdate"]),
        CheckSpec.make("day_to_day", columns=["count(*)"], group_by="CAST(o_orderdate AS DATE)",
                       num_days=7, threshold="0.9", stop_on_failure=True, description="orders per day"),
        CheckSpec.make("trending", columns=["count(*)"], threshold="0.5", description="all orders"),
        CheckSpec.make("trending_week", columns=["count(*)"], threshold="0.5", compare_type="week",
                       description="all orders", stop_on_failure=True),
        _custom_spec(spark, d, stop_on_failure=True),
    ]
    return _suite(spark, _orders_ref(spark, d), specs, OR_CTX, _orders_history(spark, d))


SEGMENT_FILTERS = [None, "o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'P'"]


def q_suite_segments(spark, d):
    """One suite per order-status segment of the same table: one shared scan."""
    orders = _t(spark, d, "orders")
    suites = [Suite(TableRef("tpch.sf.orders", orders, f), [
        CheckSpec.make("empty_null", columns=["o_orderpriority", "o_custkey"]),
        CheckSpec.make("up_to_date", columns=["o_orderdate"]),
        CheckSpec.make("trending", columns=["count(*)", "max(o_custkey) - min(o_custkey)"], threshold="0.1"),
        CheckSpec.make("missing_dates", columns=["o_orderdate"])]) for f in SEGMENT_FILTERS]
    return run_suite(spark, suites, OR_CTX)


def q_segments_distinct(spark, d):
    """Distinct counts of several key sets under four filters: one ``groupBy`` for each key set."""
    orders = _t(spark, d, "orders")
    suites = [Suite(TableRef("tpch.sf.orders", orders, f), [
        CheckSpec.make("trending", columns=["count(DISTINCT o_custkey)", "count(DISTINCT o_orderpriority, o_custkey)",
                                            "count(DISTINCT CAST(o_orderdate AS DATE))", "count(*)"], threshold="0.1"),
        CheckSpec.make("unique", columns=["o_custkey", "o_orderkey"])]) for f in SEGMENT_FILTERS]
    return run_suite(spark, suites, OR_CTX)


def q_suite_results(spark, d):
    return orders_suite(spark, d)


def q_verdicts_latest(spark, d):
    return R.verdicts(orders_suite(spark, d), OR_CTX.dq_key)


def q_day_to_day_rollup(spark, d):
    return R.rollup_day_to_day(orders_suite(spark, d), OR_CTX.dq_key)


def q_failures(spark, d):
    return R.failures(orders_suite(spark, d), OR_CTX.dq_key)


def q_summary(spark, d):
    return R.summary(orders_suite(spark, d), OR_CTX.dq_key)


def q_stop_gate_rows(spark, d):
    return R.stop_gate_rows(orders_suite(spark, d), OR_CTX.dq_key)


# -- reports over a kept table of two runs -----------------------------------------------
RERUN_CTX = OR_CTX.with_(now=dt.datetime(2001, 8, 1, 8, 30))
NEXT_CTX = RunContext.create("2001-08-02 06:00:00", now="2001-08-02 06:30:00", dq_key=996732000, env=ENV, db_user=DB_USER,
                             unix_user=UNIX_USER)


def _report_runs(spark, d) -> list[tuple[RunContext, list[Suite]]]:
    """A run over two tables, a repetition of two of its rules under the same key, and a run of the next day."""
    orders, lines = _orders_ref(spark, d), TableRef(LI_NAME, _t(spark, d, "lineitem"))
    make = CheckSpec.make

    def daily(threshold):
        return make("day_to_day", columns=["count(*)"], group_by="CAST(o_orderdate AS DATE)", num_days=7, threshold=threshold,
                    stop_on_failure=True, description="orders per day")

    return [
        (OR_CTX, [Suite(orders, [make("empty_null", columns=["o_orderstatus"]), make("unique", columns=["o_custkey"], stop_on_failure=True),
                                 daily("0.0001"), make("up_to_date", columns=["o_orderdate"])]),
                  Suite(lines, [make("unique", columns=["l_orderkey"], stop_on_failure=True), make("empty_null", columns=["l_tax"])])]),
        (RERUN_CTX, [Suite(orders, [daily("0.9"), make("up_to_date", columns=["o_orderdate"])])]),
        (NEXT_CTX, [Suite(orders, [make("unique", columns=["o_orderkey", "o_custkey"], stop_on_failure=True)]),
                    Suite(lines, [make("unique", columns=["l_orderkey,l_linenumber"], stop_on_failure=True)])]),
    ]


_KEPT: dict[tuple, tuple[SparkSession, DataFrame]] = {}


def _kept_runs(spark, d) -> DataFrame:
    """The kept table after those runs; each run is appended to a stored table and merged from there."""
    hit = _KEPT.get((id(spark), d))
    if hit is not None and hit[0] is spark:
        return hit[1]
    path, table = scratch_path(spark, "results"), f"kept_{uuid.uuid4().hex}"
    R.create_results(spark, table, scratch_path(spark, "kept"))
    for ctx, suites in _report_runs(spark, d):
        R.append_results(run_suite(spark, suites, ctx), path)
        own = R.read_results(spark, path).where((F.col("dq_run_date") == ctx.run_hour.date()) & (F.col("dq_end_tstamp") == ctx.now_col()))
        K.keep_newest(spark, own, table, scratch_path(spark, "merge"))
    kept = K.kept_results(spark, table)
    _KEPT[id(spark), d] = spark, kept
    return kept


def q_verdicts_two_runs(spark, d):
    return R.verdicts(_kept_runs(spark, d))


def q_summary_two_runs(spark, d):
    return R.summary(_kept_runs(spark, d))


def q_failures_two_runs(spark, d):
    return R.failures(_kept_runs(spark, d), NEXT_CTX.dq_key)


def q_stop_gate_two_tables(spark, d):
    return R.stop_gate_rows(_kept_runs(spark, d))


def q_isolated_run(spark, d):
    """A trial over lineitem: baselines from a stored table, verdicts and seeded band rows in a scratch table."""
    path = scratch_path(spark, "results")
    recent = _li_history(spark, d, "trending").where(F.col("dq_run_date") >= LI_ASOF - dt.timedelta(days=70))
    R.append_results(recent, path)
    specs = [CheckSpec.make("trending", columns=["count(*)"], threshold="0.1", description="lineitem rows shipped"),
             CheckSpec.make("std_dev", columns=["count(*)"], threshold="1", description="weekly band")]
    return isolated_run(spark, Suite(_li_target(spark, d), specs), LI_CTX, R.stored_results(spark, path),
                        sink=scratch_path(spark, "trial"))


OLD_LAYOUT_DROP = ["is_trial", "check_id", "dq_tgt_num", "dq_run_date"]


def q_results_evolve(spark, d):
    old = R.conform(_li_history(spark, d, "trending").drop(*OLD_LAYOUT_DROP))
    return old.unionByName(R.conform(q_trending_first_run(spark, d)))


# -- loads ---------------------------------------------------------------------------
ORDER_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]
OLD_ORDERS = "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"
NEW_ORDERS = "o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'"


def _loaded_orders(spark, d) -> DataFrame:
    """Target as loaded by an earlier run: orders before 1999."""
    return L.overwrite(_t(spark, d, "orders").where(OLD_ORDERS), ORDER_COLUMNS, LOAD_OLD_CTX)


def _new_orders(spark, d) -> DataFrame:
    """Source of this run: orders from mid-1998 on, re-priced (overlaps the target)."""
    return (_t(spark, d, "orders").where(NEW_ORDERS)
            .withColumn("o_totalprice", F.col("o_totalprice") + 100.0)
            .withColumn("o_orderstatus", F.lit("U")))


def q_stage_delete_insert(spark, d):
    orders = _t(spark, d, "orders")
    new = orders.where("year(o_orderdate) = 2000").withColumn("o_orderstatus", F.lit("S"))
    return L.stage(orders, new, "year(o_orderdate) >= 2000")


def q_load_overwrite(spark, d):
    return L.load(_loaded_orders(spark, d), _t(spark, d, "orders"), "overwrite", ORDER_COLUMNS, LOAD_CTX)


def q_load_upsert(spark, d):
    return L.load(_loaded_orders(spark, d), _new_orders(spark, d), "update", ORDER_COLUMNS, LOAD_CTX,
                  primary_key=["o_orderkey"])


def q_load_upsert_keep_audit(spark, d):
    return L.load(_loaded_orders(spark, d), _new_orders(spark, d), "update", ORDER_COLUMNS, LOAD_CTX,
                  primary_key=["o_orderkey"], restamp=False)


def q_load_append_partition(spark, d):
    # The target already holds a partial load of this very hour: it is replaced.
    partial = L.overwrite(_t(spark, d, "orders").where("o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'"),
                          ORDER_COLUMNS, LOAD_CTX)
    tgt = _loaded_orders(spark, d).unionByName(partial)
    return L.load(tgt, _new_orders(spark, d), "append", ORDER_COLUMNS, LOAD_CTX)


def q_load_append_delete(spark, d):
    return L.load(_loaded_orders(spark, d), _new_orders(spark, d), "append", ORDER_COLUMNS, LOAD_CTX,
                  delete="o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'")


PART_COLUMNS = [*ORDER_COLUMNS, ("p", "string")]
PART_KEY = "CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'it''s high' ELSE o_orderpriority END"


def _partitioned_orders(spark, d) -> str:
    """A catalog table of the orders before 1999, partitioned by a key with NULL and quoted values."""
    name = f"orders_{uuid.uuid4().hex}"
    L.create_table(spark, name, PART_COLUMNS, ["p"], scratch_path(spark, "orders"))
    old = _t(spark, d, "orders").where(OLD_ORDERS).withColumn("p", F.expr(PART_KEY))
    L.write_overwrite(spark, name, L.overwrite(old, PART_COLUMNS, LOAD_OLD_CTX))
    return name


def q_load_upsert_partitioned(spark, d):
    """Orders of two priorities move to another partition: one of theirs is left empty."""
    name = _partitioned_orders(spark, d)
    src = (_t(spark, d, "orders").where("o_orderpriority IN ('5-LOW', '2-HIGH') AND (o_orderpriority = '5-LOW' OR o_orderkey % 3 = 0)")
           .withColumn("p", F.lit("moved/low=1")))
    L.write_upsert_partitions(spark, name, src, ["o_orderkey"], PART_COLUMNS, LOAD_CTX, scratch_path(spark, "staging"))
    return spark.table(name)


def q_load_upsert_key_ranges(spark, d):
    """Two updates of a few neighbouring keys: partitions are searched only where their kept key range meets them."""
    name = f"orders_{uuid.uuid4().hex}"
    L.create_table(spark, name, PART_COLUMNS, ["p"], scratch_path(spark, "orders"))
    orders = _t(spark, d, "orders").withColumn("p", F.expr("concat('k', length(bin(o_orderkey)))"))
    L.write_overwrite(spark, name, L.overwrite(orders, PART_COLUMNS, LOAD_OLD_CTX))
    ranges = KeyRanges(spark, name, "o_orderkey", scratch_path(spark, "ranges"))
    for lo, hi, status in ((100, 200, "1"), (150, 600, "2")):
        src = orders.where(F.col("o_orderkey").between(lo, hi)).withColumn("o_orderstatus", F.lit(status))
        L.write_upsert_partitions(spark, name, src, "o_orderkey", PART_COLUMNS, LOAD_CTX, scratch_path(spark, "staging"),
                                  ranges=ranges)
    return spark.table(name)


def q_load_delete_insert(spark, d):
    name = _partitioned_orders(spark, d)
    new = L.overwrite(_new_orders(spark, d).withColumn("p", F.expr(PART_KEY)), PART_COLUMNS, LOAD_CTX)
    L.write_delete_insert(spark, name, new, "o_orderdate >= TIMESTAMP '1998-07-01 00:00:00' OR p = '4-NOT SPECIFIED'",
                          scratch_path(spark, "staging"))
    return spark.table(name)


CONV_COLUMNS = [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")]


def q_load_upsert_composite(spark, d):
    conv = _t(spark, d, "conversations")
    tgt = L.overwrite(conv.where("turn <= 2"), CONV_COLUMNS, LOAD_OLD_CTX)
    src = conv.where("turn >= 2").withColumn("text", F.concat("text", F.lit(" [edited]")))
    return L.load(tgt, src, "update", CONV_COLUMNS, LOAD_CTX, primary_key=["conv_id", "turn"])


OBS_CTX = RunContext.create("2001-08-02 07:00:00", now="2001-08-02 07:05:00", dq_key=996735601,
                            env=ENV, db_user=DB_USER, unix_user=UNIX_USER)


def q_load_observed_checks(spark, d):
    """Scalar checks observed while the load writes (here to the noop sink)."""
    from tableguard.plans.observe import ObservedChecks
    specs = [CheckSpec.make("empty_null", columns=["o_orderstatus", "o_custkey"]),
             CheckSpec.make("up_to_date", columns=["o_orderdate"]),
             CheckSpec.make("trending", columns=["count(*)"], threshold="0.1")]
    oc = ObservedChecks("tpch.sf.orders", specs, OBS_CTX)
    rows = L.overwrite(_t(spark, d, "orders"), ORDER_COLUMNS, OBS_CTX)
    rows.transform(oc.attach).write.format("noop").mode("overwrite").save()
    return oc.results(spark)


def q_suite_file_statistics(spark, d):
    """Rules over orders whose metrics file footers hold."""
    specs = [CheckSpec.make("trending", columns=["count(*)", "count(o_totalprice)", "max(o_custkey)", "min(o_orderkey)"], threshold="0.1")]
    return StatisticsChecks(spark, "tpch.sf.orders", f"{d}/orders.parquet", specs).results(OR_CTX)


def q_suite_incremental(spark, d):
    """Rules over a partitioned copy of orders that grows between two runs: the second reads what is new."""
    path, root = scratch_path(spark, "orders"), scratch_path(spark, "partials")
    orders = _t(spark, d, "orders")

    def grow(rows):
        rows.write.mode("append").partitionBy("o_orderstatus").parquet(path)

    specs = [CheckSpec.make("empty_null", columns=["o_orderpriority", "o_custkey"]),
             CheckSpec.make("up_to_date", columns=["o_orderdate"]),
             CheckSpec.make("trending", columns=["count(*)", "sum(o_custkey)", "max(o_custkey)", "min(o_orderkey)"], threshold="0.1")]
    grow(orders.where("o_orderstatus <> 'P'"))
    checks = IncrementalChecks(spark, "tpch.sf.orders", path, specs, root)
    checks.partials()
    grow(orders.where("o_orderstatus = 'P'"))
    return checks.results(OR_CTX)


def q_audit_columns(spark, d):
    return L.with_audit(_t(spark, d, "nation"), LOAD_CTX)


# -- freshness ------------------------------------------------------------------------
WANTED_TABLES = ["web.click", "web.view", "web.purchase", "web.signup", "web.error", "web.refund"]
WANTED_TASKS = ["etl.purchase", "etl.signup", "etl.click"]
LOG_DBS = ["analytics"]


def _upload_log(spark, d) -> DataFrame:
    return _t(spark, d, "events").select(
        F.lit("analytics").alias("db_name"), F.lit("web").alias("schema_name"),
        F.col("event_type").alias("table_name"), F.col("ts").alias("last_update_time"))


def _task_log(spark, d) -> DataFrame:
    return _t(spark, d, "events").select(
        F.lit("ETL").alias("db_schema"), F.col("event_type").alias("task"),
        F.when(F.col("value") > 50, F.lit("end")).otherwise(F.lit("start")).alias("action"),
        F.col("ts").alias("log_time"))


def q_table_freshness(spark, d):
    return FR.table_freshness(_upload_log(spark, d), WANTED_TABLES, LOG_DBS, dt.date(2024, 1, 30))


def q_task_freshness(spark, d):
    return FR.task_freshness(_task_log(spark, d), WANTED_TASKS, dt.date(2024, 1, 30))


def q_freshness_kept(spark, d):
    """Freshness without a look-back, from a state that a growing log advanced in three steps."""
    name = f"fresh_{uuid.uuid4().hex}"
    root = scratch_path(spark, "freshness")
    FR.create_state(spark, name, root)
    log = _upload_log(spark, d).withColumn("day", F.to_date("last_update_time"))
    for end in ("2024-01-10", "2024-01-20", "2024-02-01"):
        FR.advance_tables(spark, name, root, log.where(F.col("day") < end), "day")
    tasks = _task_log(spark, d).withColumn("day", F.to_date("log_time"))
    FR.advance_tasks(spark, name, root, tasks.where("day < DATE'2024-01-12'"), "day")
    as_of = dt.date(2024, 1, 30)
    state = spark.table(name)
    return (FR.readiness(spark, FR.kept_tables(state, WANTED_TABLES, LOG_DBS), WANTED_TABLES, as_of, "table")
            .unionByName(FR.readiness(spark, FR.kept_tasks(state, WANTED_TASKS), WANTED_TASKS, as_of, "task")))


def q_readiness(spark, d):
    tables = FR.readiness(spark, q_table_freshness(spark, d), WANTED_TABLES, dt.date(2024, 1, 30), "table")
    as_of = dt.date(2024, 1, 31)
    tasks = FR.readiness(spark, FR.task_freshness(_task_log(spark, d), WANTED_TASKS, as_of),
                         WANTED_TASKS, as_of, "task")
    return tables.unionByName(tasks)


# ---------------------------------------------------------------------------
# Contract
# ---------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the fused check suite over orders at sf0.001."""
    return orders_suite(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {}
    for n in TRENDING:
        q[n] = _trending_query(n)
    q["trending_first_run"] = q_trending_first_run
    q["compare_to_source"] = q_compare_to_source
    q["compare_to_source_empty"] = q_compare_to_source_empty
    for n in DAY_TO_DAY:
        q[n] = _d2d_query(n)
    q["empty_null"] = q_empty_null
    q["unique"] = q_unique
    q["unique_composite"] = q_unique_composite
    q["up_to_date"] = q_up_to_date
    q["up_to_date_stale"] = q_up_to_date_stale
    q["missing_dates"] = q_missing_dates
    q["missing_dates_empty"] = q_missing_dates_empty
    for n in STD_DEV:
        q[n] = _std_query(n)
    q["std_dev_all_series"] = q_std_dev_all_series
    q["std_dev_seed"] = q_std_dev_seed
    q["custom_check"] = q_custom_check
    q["trending_distinct"] = q_trending_distinct
    q["trending_stored_history"] = q_trending_stored_history
    q["suite_results"] = q_suite_results
    q["segments_distinct"] = q_segments_distinct
    q["suite_segments"] = q_suite_segments
    q["verdicts_latest"] = q_verdicts_latest
    q["day_to_day_rollup"] = q_day_to_day_rollup
    q["failures"] = q_failures
    q["summary"] = q_summary
    q["stop_gate_rows"] = q_stop_gate_rows
    q["verdicts_two_runs"] = q_verdicts_two_runs
    q["summary_two_runs"] = q_summary_two_runs
    q["failures_two_runs"] = q_failures_two_runs
    q["stop_gate_two_tables"] = q_stop_gate_two_tables
    q["isolated_run"] = q_isolated_run
    q["results_evolve"] = q_results_evolve
    q["stage_delete_insert"] = q_stage_delete_insert
    q["load_overwrite"] = q_load_overwrite
    q["load_upsert"] = q_load_upsert
    q["load_upsert_keep_audit"] = q_load_upsert_keep_audit
    q["load_append_partition"] = q_load_append_partition
    q["load_append_delete"] = q_load_append_delete
    q["load_upsert_composite"] = q_load_upsert_composite
    q["load_upsert_partitioned"] = q_load_upsert_partitioned
    q["load_upsert_key_ranges"] = q_load_upsert_key_ranges
    q["load_delete_insert"] = q_load_delete_insert
    q["suite_file_statistics"] = q_suite_file_statistics
    q["suite_incremental"] = q_suite_incremental
    q["audit_columns"] = q_audit_columns
    q["load_observed_checks"] = q_load_observed_checks
    q["table_freshness"] = q_table_freshness
    q["task_freshness"] = q_task_freshness
    q["readiness"] = q_readiness
    q["freshness_kept"] = q_freshness_kept
    return q | _text_queries()[0]


def _text_queries() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the text operators and their pipeline, as far as those can be imported."""
    try:
        text = import_module("tableguard.llm.queries")
    except ImportError:
        return {}, {}
    found, sql = dict(text.QUERIES), dict(text.ORACLES)
    try:
        pipeline = import_module("corpus_pipeline")
    except ImportError:
        return found, sql
    found["pipeline"] = pipeline.run
    if pipeline.ORACLE_SQL:
        sql["pipeline"] = pipeline.ORACLE_SQL
    return found, sql


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLES
    return ORACLES | _text_queries()[1]
