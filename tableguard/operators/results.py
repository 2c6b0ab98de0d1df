"""Result / history table: schema, projection, sink and the reports over it.

The table is append-only and partitioned by ``dq_run_date`` so history
lookups (which always name run dates or an upper bound) prune partitions.
The 21 leading columns keep their historical order; ``check_id`` (the rule
name, so variants of one family are distinguishable), ``dq_tgt_num`` (numeric
twin of the target value, so baselines never parse text), ``rule_column`` (the
rule's column without the key that a day_to_day row adds to its label) and the
partition column follow.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..scratch import scratch_root

# Result table columns 1-21 in their stored order.
RESULT_FIELDS = [
    ("dq_run_hour", T.TimestampNTZType()),
    ("database_name", T.StringType()),
    ("schema_name", T.StringType()),
    ("table_name", T.StringType()),
    ("table_filter", T.StringType()),
    ("dq_name", T.StringType()),
    ("dq_column", T.StringType()),
    ("dq_description", T.StringType()),
    ("dq_tgt_value", T.StringType()),
    ("dq_src_value", T.StringType()),
    ("dq_threshold", T.StringType()),
    ("is_pass", T.BooleanType()),
    ("stop_on_failure", T.BooleanType()),
    ("is_dq_custom", T.BooleanType()),
    ("dq_key", T.LongType()),
    ("dq_start_tstamp", T.TimestampNTZType()),
    ("dq_end_tstamp", T.TimestampNTZType()),
    ("db_username", T.StringType()),
    ("unix_username", T.StringType()),
    ("env", T.StringType()),
    ("is_trial", T.BooleanType()),
]
EXTRA_FIELDS = [
    ("check_id", T.StringType()),
    ("dq_tgt_num", T.DoubleType()),
    ("rule_column", T.StringType()),
    ("dq_run_date", T.DateType()),
]
RESULT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RESULT_FIELDS + EXTRA_FIELDS])
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]
PARTITION_COLUMN = "dq_run_date"
SERIES_KEYS = ["database_name", "schema_name", "table_name", "dq_name", "dq_column", "env"]

# Columns a plan must produce per verdict row before ``to_result`` stamps the run.
VERDICT_COLUMNS = [
    "database_name", "schema_name", "table_name", "table_filter", "check_id", "dq_name",
    "dq_column", "dq_description", "dq_tgt_value", "dq_src_value", "dq_threshold",
    "is_pass", "stop_on_failure", "is_dq_custom", "is_trial", "dq_tgt_num", "rule_column",
]

# Fixed value: the target text of a rolled-up day_to_day rule.
ROLLUP_TEXT = "<<< check dq table >>>"


def to_result(rows: DataFrame, ctx: RunContext) -> DataFrame:
    """V1: stamp run constants onto verdict rows and order the columns."""
    from ..functions import sql as Q
    ts = lambda t: f"CAST('{t.strftime('%Y-%m-%d %H:%M:%S')}' AS TIMESTAMP_NTZ)"
    stamped = {
        "dq_run_hour": ts(ctx.run_hour),
        "dq_key": f"{int(ctx.dq_key)}L",
        "dq_start_tstamp": ts(ctx.now),
        "dq_end_tstamp": ts(ctx.now),
        "db_username": Q.lit(ctx.db_user),
        "unix_username": Q.lit(ctx.unix_user),
        "env": Q.lit(ctx.env),
        "dq_run_date": f"DATE'{ctx.run_hour.date().isoformat()}'",
    }
    have = set(rows.columns)
    exprs = []
    for f in RESULT_SCHEMA.fields:
        e = stamped.get(f.name, Q.ident(f.name) if f.name in have else "NULL")
        exprs.append(f"CAST({e} AS {f.dataType.simpleString()}) AS {f.name}")
    return rows.selectExpr(*exprs)


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def create_results(spark: SparkSession, table: str, location: str | None = None) -> None:
    """V2: create the partitioned Parquet result table if it does not exist."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RESULT_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
              f"PARTITIONED BY ({PARTITION_COLUMN}){loc}")


def evolve_results(spark: SparkSession, table: str) -> list[str]:
    """V3 for a catalog table: add the result columns an older layout lacks
    (``ALTER TABLE ... ADD COLUMNS``; existing files read them as NULL).
    Returns the added column names."""
    have = {c.lower() for c in spark.table(table).columns}
    missing = [f for f in RESULT_SCHEMA.fields if f.name.lower() not in have]
    if missing:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in missing]


def conform(df: DataFrame) -> DataFrame:
    """V3: bring a result frame of an older layout to the current one.

    Columns added since (``is_trial``, ``check_id``, ``dq_tgt_num``) become NULL;
    a missing numeric twin is recovered from the text with ``try_cast`` and a
    missing run date from the run hour.
    """
    have = set(df.columns)
    cols = []
    for f in RESULT_SCHEMA.fields:
        if f.name in have:
            c = F.col(f.name)
        elif f.name == "dq_tgt_num" and "dq_tgt_value" in have:
            c = F.col("dq_tgt_value").try_cast("double")
        elif f.name == "dq_run_date" and "dq_run_hour" in have:
            c = F.to_date("dq_run_hour")
        elif f.name == "check_id" and "dq_name" in have:
            c = F.col("dq_name")
        elif f.name == "rule_column" and {"dq_name", "dq_column"} <= have:
            c = _label_column()
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Read the result table at ``path`` with the current schema.

    Files written before a column existed read it as NULL (no footer-merging
    pass over every file, which would grow with the table's age); the numeric
    twin and the rule id of such rows are recovered from their text.
    """
    df = spark.read.schema(RESULT_SCHEMA).parquet(path)
    return df.withColumns({
        "check_id": F.coalesce(F.col("check_id"), F.col("dq_name")),
        "dq_tgt_num": F.coalesce(F.col("dq_tgt_num"), F.col("dq_tgt_value").try_cast("double")),
        "rule_column": F.coalesce(F.col("rule_column"), _label_column()),
    }).select(*RESULT_COLUMNS)


@dataclass(frozen=True)
class StoredResults:
    """A stored result table with the run dates it has partitions for, newest first.  Give it to ``run_suite``
    as the history, so that rules which compare with the last run read the newest run dates first."""

    frame: DataFrame
    dates: list[_dt.date]


def stored_results(spark: SparkSession, path: str | None = None, table: str | None = None) -> StoredResults:
    """The result table at ``path`` (or ``table`` of the catalog) as it is now.  Its run dates come from the
    listing of partitions, which holds one entry a run date or file and no rows."""
    if table is not None:
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        frame = conform(spark.table(table))
    else:
        frame = read_results(spark, path)
        names = frame.inputFiles()
    found = {m[1] for m in (re.search(rf"{PARTITION_COLUMN}=(\d{{4}}-\d{{2}}-\d{{2}})(?:/|$)", n) for n in names) if m}
    return StoredResults(frame, sorted(map(_dt.date.fromisoformat, found), reverse=True))


def scratch_results_path(spark: SparkSession, dq_key: int, fallback: str | None = None) -> str:
    """Where an isolated (trial) run writes its verdicts (``plans.isolated``): a folder of the run under the
    cluster's shared folder (``fallback`` where a session has none set), so a trial never becomes a later run's
    baseline."""
    base = spark.conf.get("spark.checkpoint.dir", None) or fallback or scratch_root(spark)
    return f"{base.rstrip('/')}/tableguard-scratch/{int(dq_key)}"


def append_results(df: DataFrame, path: str | None = None, table: str | None = None) -> None:
    """One append per suite, partitioned by run date.

    ``rebalance`` lets AQE size the output files: a suite's handful of rows
    becomes one file per run instead of one per union branch.
    """
    df = df.select(*RESULT_COLUMNS).hint("rebalance")
    if table is not None:
        # insertInto is positional: follow the table's own column order
        df.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)
    else:
        df.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)


def _label_column() -> Column:
    """The rule's column of rows written before it was stored: a day_to_day label without its ``[key]``."""
    return F.when(F.col("dq_name") == "day_to_day", F.regexp_extract("dq_column", r"(?s)^(.*) \[", 1)).otherwise(F.col("dq_column"))


def _newest_order() -> Column:
    """Newest first; of rows written at the same time (segments of one run) a failing one wins, so it
    cannot hide behind one that passed."""
    return F.struct("dq_end_tstamp", "dq_start_tstamp", (~F.coalesce("is_pass", F.lit(False))).alias("failing"),
                    "dq_tgt_value")


def verdicts(results: DataFrame, dq_key: int | None = None) -> DataFrame:
    """V5: one verdict per (run, rule, column): newest row by end time.

    ``max_by`` over (end time, start time, target text) is a partially
    aggregated reduction (no sort of the result table); NULL end times rank
    last.  day_to_day rows are not included here; see ``rollup_day_to_day``.
    """
    r = results if dq_key is None else results.where(F.col("dq_key") == dq_key)
    r = r.where(F.col("dq_name") != "day_to_day")
    newest = F.max_by(F.struct("table_name", "dq_name", "is_pass", "dq_tgt_value", "dq_src_value",
                               "dq_threshold", "stop_on_failure"),
                      _newest_order())
    return (r.groupBy("dq_key", "database_name", "schema_name", "table_name", "check_id", "dq_column")
            .agg(newest.alias("n"))
            .select("dq_key", "n.table_name", "check_id", "n.dq_name", "dq_column", "n.is_pass",
                    "n.dq_tgt_value", "n.dq_src_value", "n.dq_threshold", "n.stop_on_failure"))


def rollup_day_to_day(results: DataFrame, dq_key: int | None = None) -> DataFrame:
    """V6: all group rows of one day_to_day column pass iff none fails."""
    r = results if dq_key is None else results.where(F.col("dq_key") == dq_key)
    r = r.where(F.col("dq_name") == "day_to_day")
    fails = F.sum(F.when(~F.col("is_pass"), 1).otherwise(0))
    return (r.groupBy("dq_key", "database_name", "schema_name", "table_name", "check_id", "dq_name",
                      F.col("rule_column").alias("dq_column"))
            .agg(F.coalesce(fails == 0, F.lit(False)).alias("is_pass"),
                 F.lit(ROLLUP_TEXT).alias("dq_tgt_value"),
                 F.lit(None).cast("string").alias("dq_src_value"),
                 F.max("dq_threshold").alias("dq_threshold"),
                 F.max(F.col("stop_on_failure").cast("int")).cast("boolean").alias("stop_on_failure"),
                 F.count(F.lit(1)).alias("n_keys"),
                 fails.alias("n_fails"))
            .drop("database_name", "schema_name"))


def failures(results: DataFrame, dq_key: int | None = None) -> DataFrame:
    """V7: failing rows of a run (what a notification would carry).  A NULL target fails, as in ``summary``."""
    r = results if dq_key is None else results.where(F.col("dq_key") == dq_key)
    return (r.where(~F.coalesce(F.col("is_pass") & F.col("dq_tgt_value").isNotNull(), F.lit(False)))
            .select(F.concat_ws(".", "database_name", "schema_name", "table_name").alias("target_table"),
                    "check_id", "dq_name", "dq_column", "dq_tgt_value", "dq_src_value",
                    "stop_on_failure"))


EXPECTED_KEYS = ["dq_key", "database_name", "schema_name", "table_name", "check_id", "dq_column"]


def _rule_verdicts(results: DataFrame, dq_key: int | None, expected: DataFrame | None) -> DataFrame:
    """Verdicts and day_to_day rollups of a run; with ``expected`` (see
    ``plans.suite.expected_rules``) every expected rule appears, and one that
    produced no row at all gets a NULL verdict (reported as a failure)."""
    cols = ["dq_key", "table_name", "check_id", "dq_name", "dq_column", "is_pass",
            "dq_tgt_value", "dq_src_value", "dq_threshold", "stop_on_failure"]
    r = results if dq_key is None else results.where(F.col("dq_key") == dq_key)
    # One pass: a rule's rows (one per run, or one per key for day_to_day)
    # meet in one group.  Plain rules take their newest row (``max_by`` over
    # end time, start time, target text: the ``verdicts`` order, partially
    # aggregated); day_to_day rules roll up to "no failing key".
    d2d = F.col("dq_name") == "day_to_day"
    column = F.when(d2d, F.col("rule_column")).otherwise(F.col("dq_column"))
    newest = F.max_by(F.struct("is_pass", "dq_tgt_value", "dq_src_value", "dq_threshold", "stop_on_failure"),
                      _newest_order())
    fails = F.sum(F.when(~F.col("is_pass"), 1).otherwise(0))
    g = (r.groupBy("dq_key", "database_name", "schema_name", "table_name", "check_id", "dq_name",
                   column.alias("dq_column"))
         .agg(newest.alias("n"), fails.alias("_fails"), F.max("dq_threshold").alias("_thr"),
              F.max(F.col("stop_on_failure").cast("int")).alias("_stop")))
    is_d2d = F.col("dq_name") == "day_to_day"
    both = g.select(
        "dq_key", "database_name", "schema_name", "table_name", "check_id", "dq_name", "dq_column",
        F.when(is_d2d, F.coalesce(F.col("_fails") == 0, F.lit(False)))
        .otherwise(F.col("n.is_pass") & F.col("n.dq_tgt_value").isNotNull()).alias("is_pass"),
        F.when(is_d2d, F.lit(ROLLUP_TEXT)).otherwise(F.col("n.dq_tgt_value")).alias("dq_tgt_value"),
        F.when(is_d2d, F.lit(None).cast("string")).otherwise(F.col("n.dq_src_value")).alias("dq_src_value"),
        F.when(is_d2d, F.col("_thr")).otherwise(F.col("n.dq_threshold")).alias("dq_threshold"),
        F.when(is_d2d, F.col("_stop").cast("boolean")).otherwise(F.col("n.stop_on_failure"))
        .alias("stop_on_failure"))
    if expected is None:
        return both.select(*cols)
    if dq_key is not None:
        expected = expected.where(F.col("dq_key") == dq_key)
    got = both.drop("dq_name", "stop_on_failure")
    # ``expected`` has one row per configured rule and column: broadcast it.
    return (F.broadcast(expected).join(got, EXPECTED_KEYS, "left")
            .select(*cols))


def summary(results: DataFrame, dq_key: int | None = None, expected: DataFrame | None = None) -> DataFrame:
    """V8: one line per (rule, column): PASS / FAIL with the values.

    A NULL target renders as an empty string and fails (the line is still
    produced); with ``expected``, a rule that returned no row fails too.
    """
    both = _rule_verdicts(results, dq_key, expected)
    name = F.when(F.length("dq_column") > 0,
                  F.concat(F.col("dq_name"), F.lit(" for "), F.col("dq_column"))).otherwise(F.col("dq_name"))
    detail = F.concat(F.lit("[tgt="), F.coalesce("dq_tgt_value", F.lit("")),
                      F.lit("; src="), F.coalesce("dq_src_value", F.lit("")),
                      F.lit("; threshold="), F.coalesce("dq_threshold", F.lit("")), F.lit("]"))
    ok = F.coalesce(F.col("is_pass") & F.col("dq_tgt_value").isNotNull(), F.lit(False))
    return both.select("dq_key", "table_name", "check_id", name.alias("test_name"),
                       detail.alias("detail"),
                       F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"))


def stop_gate_rows(results: DataFrame, dq_key: int | None = None,
                   expected: DataFrame | None = None) -> DataFrame:
    """V9 (rows): failing verdicts of rules marked ``stop_on_failure``."""
    v = _rule_verdicts(results, dq_key, expected).select(
        "dq_key", "table_name", "check_id", "dq_column", "is_pass", "stop_on_failure")
    return v.where(~F.coalesce("is_pass", F.lit(False)) & F.col("stop_on_failure"))


class StopOnFailure(RuntimeError):
    """Raised by ``stop_gate`` after all checks ran."""


def stop_gate(results: DataFrame, dq_key: int | None = None, expected: DataFrame | None = None) -> None:
    """V9: raise iff a failing rule has ``stop_on_failure`` (one tiny action)."""
    hit = stop_gate_rows(results, dq_key, expected).limit(1).collect()
    if hit:
        row = hit[0]
        raise StopOnFailure(f"DQ failed: {row['check_id']} on {row['dq_column']!r} "
                            f"({row['table_name']}) has stop_on_failure")
