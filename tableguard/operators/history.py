"""Baselines read from the result (history) table.

All functions are set-based: one pass over the history rows of every wanted
series, keyed by ``(check_id, dq_column)``.  ``wanted`` are the series the
current suite asks for (one row per rule and column, built from the suite's
configuration, so their number is bounded by the number of rules and their
frame is broadcast); given as rows, they also reach the scan as ``IN`` lists.
The history table is partitioned by ``dq_run_date``; every lookup carries a
static date predicate so Parquet partition pruning applies.

Rules that compare with a fixed date read that date's partitions only.  Rules
that compare with the last run have no such date.  Over a ``StoredResults``
(whose run dates are known from the listing of its partitions) they read the
newest run date, then the two before it, then four, and so on, each time for
the series not found yet: an exact search of any depth that reads, for each
series, at most about twice the run dates since its last run.  Over any other
frame they read all dates up to the run's.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..functions import round_int
from .results import RESULT_COLUMNS, StoredResults

WANTED_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("database_name", T.StringType()),
    T.StructField("schema_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("dq_column", T.StringType()),
    T.StructField("cmp_date", T.DateType()),
])
# Week offsets (days) of the std_dev history, newest first.
WEEK_OFFSETS = (7, 14, 21, 28, 35, 42, 49, 56)
SEED_LOOKBACK_DAYS = 63  # nine weeks


def compare_date(as_of: _dt.date, compare_type: str | None) -> _dt.date | None:
    """Run date a trending rule compares with; ``None`` means the last run."""
    if compare_type is None:
        return None
    if compare_type == "day":
        return as_of - _dt.timedelta(days=1)
    if compare_type == "week":
        return as_of - _dt.timedelta(days=7)
    months = {"month": 1, "year": 12}[compare_type]
    y, m = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    m += 1
    import calendar
    d = min(as_of.day, calendar.monthrange(y, m)[1])
    return _dt.date(y, m, d)


def wanted_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, WANTED_SCHEMA)


BASELINE_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("dq_column", T.StringType()),
    T.StructField("base_num", T.DoubleType()),
])
Wanted = DataFrame | list[tuple]


def frame_of(history: DataFrame | StoredResults) -> DataFrame:
    return history.frame if isinstance(history, StoredResults) else history


def _series(history: DataFrame, wanted: Wanted, dq_name: str, ctx: RunContext) -> DataFrame:
    h = history.where((F.col("dq_name") == dq_name) & (F.col("env") == ctx.env)).drop("check_id")
    if isinstance(wanted, list):
        for i in range(1, 5):
            h = h.where(F.col(WANTED_SCHEMA[i].name).isin(sorted({w[i] for w in wanted})))
        wanted = wanted_frame(history.sparkSession, wanted)
    return h.join(F.broadcast(wanted),
                  ["database_name", "schema_name", "table_name", "dq_column"], "inner")


def _newest(history: DataFrame, wanted: Wanted, ctx: RunContext, dates: list[_dt.date] | None) -> DataFrame:
    """Value of the newest earlier ``trending`` row per wanted series, of the given run dates or of all up to
    the run's.  ``max_by`` is a partial aggregation, so a series with many runs does not gather in one task."""
    h = history.where(F.col("dq_run_date").isin(dates) if dates is not None
                      else F.col("dq_run_date") <= F.lit(ctx.run_hour.date()))
    h = h.where((F.col("dq_run_hour") <= ctx.run_hour_col())
                & (F.coalesce(F.col("dq_key"), F.lit(-1)) != F.lit(ctx.dq_key)))
    j = _series(h, wanted, "trending", ctx).where(
        F.col("cmp_date").isNull() | (F.to_date("dq_run_hour") == F.col("cmp_date")))
    order = F.struct("dq_run_hour", "dq_end_tstamp", "dq_key")
    value = F.coalesce(F.col("dq_tgt_num"), F.col("dq_tgt_value").try_cast("double"))
    return j.groupBy("check_id", "dq_column").agg(F.max_by(value, order).alias("base_num"))


def _last_runs(stored: StoredResults, wanted: list[tuple], ctx: RunContext) -> DataFrame:
    """Newest rows by probes of run dates, newest first, in doubling steps, until every series is found or no
    date is left.  A probe brings back one row for each series found."""
    dates = [d for d in stored.dates if d <= ctx.run_hour.date()]
    found, left, step = [], wanted, 1
    while left and dates:
        now, dates = dates[:step], dates[step:]
        rows = _newest(stored.frame, left, ctx, now).collect()
        found += [tuple(r) for r in rows]
        have = {(r["check_id"], r["dq_column"]) for r in rows}
        left = [w for w in left if (w[0], w[4]) not in have]
        step *= 2
    return stored.frame.sparkSession.createDataFrame(found, BASELINE_SCHEMA)


def trending_baselines(history: DataFrame | StoredResults, wanted: Wanted, ctx: RunContext,
                       cmp_dates: list[_dt.date | None]) -> DataFrame:
    """Value of the newest earlier ``trending`` row per wanted series.

    A row qualifies when it belongs to another run, its run hour is not after
    the current one and, for compare types, its run date is the compare date.
    Newest = (run hour, end time, key) descending.  Series with a compare date
    and series that want their last run are looked up apart, so the former
    never widen to all dates.  Returns ``check_id, dq_column, base_num``.
    """
    if not isinstance(wanted, list):
        dated = bool(cmp_dates) and all(d is not None for d in cmp_dates)
        return _newest(frame_of(history), wanted, ctx, sorted(set(cmp_dates)) if dated else None)
    dated, last = [w for w in wanted if w[5] is not None], [w for w in wanted if w[5] is None]
    parts = []
    if dated:
        parts.append(_newest(frame_of(history), dated, ctx, sorted({w[5] for w in dated})))
    if last:
        parts.append(_last_runs(history, last, ctx) if isinstance(history, StoredResults)
                     else _newest(history, last, ctx, None))
    return reduce(DataFrame.unionByName, parts)


def weekly_band_stats(history: DataFrame | StoredResults, wanted: Wanted, ctx: RunContext) -> DataFrame:
    """C18 steps 1-6: per wanted series, the weekly points and their diffs.

    Only run dates ``as_of - 7k`` (k = 1..8) are read (partition pruned); the
    newest run of each date is kept; ``v`` is its value rounded to an integer (a double);
    ``diff`` is ``v`` minus the previous kept point.  Returns
    ``check_id, dq_column, last_value, avg_diff, sd_diff, num_weeks``:
    ``last_value`` is the point of ``as_of - 7`` or 0 when that week is absent,
    ``sd_diff`` is the sample standard deviation (NULL below two diffs).
    """
    dates = [ctx.as_of - _dt.timedelta(days=k) for k in WEEK_OFFSETS]
    h = frame_of(history).where(F.col("dq_run_date").isin(dates)
                      & F.to_date("dq_run_hour").isin(dates))
    j = _series(h, wanted, "std_dev", ctx)
    value = F.coalesce(F.col("dq_tgt_num"), F.col("dq_tgt_value").try_cast("double"))
    per_date = (j.groupBy("check_id", "dq_column", F.to_date("dq_run_hour").alias("run_date"))
                .agg(F.max_by(round_int(value), F.struct("dq_run_hour", "dq_end_tstamp", "dq_key"))
                     .alias("v")))
    # At most eight rows per series reach this window.
    w = Window.partitionBy("check_id", "dq_column").orderBy("run_date")
    last_week = F.lit(ctx.as_of - _dt.timedelta(days=7))
    return (per_date.withColumn("diff", F.col("v") - F.lag("v").over(w))
            .groupBy("check_id", "dq_column")
            .agg(F.max(F.when(F.col("run_date") == last_week, F.col("v")).otherwise(F.lit(0)))
                 .alias("last_value"),
                 F.avg("diff").alias("avg_diff"),
                 F.stddev_samp("diff").alias("sd_diff"),
                 F.count(F.lit(1)).alias("num_weeks")))


def seed_std_dev(history: DataFrame | StoredResults, database: str, schema: str, table: str,
                 columns: list[str], ctx: RunContext) -> DataFrame:
    """Copy the last nine weeks of ``trending`` rows as ``std_dev`` history.

    Copied rows are marked trial, failing and keyless, exactly as a seeded
    baseline has always looked; they keep their run hour and value.
    """
    since = _dt.datetime.combine(ctx.as_of - _dt.timedelta(days=SEED_LOOKBACK_DAYS), _dt.time())
    h = frame_of(history).where((F.col("dq_run_date") >= F.lit(since.date()))
                      & (F.col("dq_run_hour") > F.lit(since.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
                      & (F.col("database_name") == database) & (F.col("schema_name") == schema)
                      & (F.col("table_name") == table) & (F.col("dq_name") == "trending")
                      & F.col("dq_column").isin(list(columns)) & (F.col("env") == ctx.env))
    null_s, null_ts = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    out = {
        "dq_name": F.lit("std_dev"),
        "dq_description": F.lit("Initial trending for std_dev"),
        "dq_src_value": null_s,
        "dq_threshold": null_s,
        "is_pass": F.lit(False),
        "stop_on_failure": F.lit(False),
        "is_dq_custom": F.lit(False),
        "dq_key": F.lit(None).cast("bigint"),
        "dq_start_tstamp": null_ts,
        "dq_end_tstamp": null_ts,
        "db_username": null_s,
        "unix_username": null_s,
        "is_trial": F.lit(True),
        "check_id": F.lit("std_dev"),
    }
    return h.select(*[out[c].alias(c) if c in out else F.col(c) for c in RESULT_COLUMNS])
