"""Upstream readiness (F1-F4) from upload and task logs.

A growing log need not be read anew each time: ``advance_tables`` / ``advance_tasks`` keep the newest time of every
name in a small versioned table and read only the log's partitions from the last one seen on (that one again,
as it may have grown; a maximum does not mind).  ``kept_tables`` / ``kept_tasks`` answer from it without a look-back.

The logs are event tables; readiness is one filtered, grouped ``max`` per
wanted name.  The wanted list is configuration (a handful of names), so it is
turned into a small frame and joined; the log side is never collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.logs import task_log as _task_log
from ..sources.logs import upload_log as _upload_log
from . import versions

# Default look-back of the log scans and the status words.
LOOKBACK_DAYS = 10
READY, WAITING, MISSING = "READY", "WAITING", "MISSING"


class UpstreamMissing(RuntimeError):
    """A wanted table or task has no log row inside the look-back."""


def _lower_list(names) -> list[str]:
    return sorted({n.lower() for n in names})


def _since(time: str, as_of: _dt.date, lookback_days: int | None) -> Column:
    if lookback_days is None:
        return F.lit(True)
    return F.to_date(time) > F.lit(as_of - _dt.timedelta(days=lookback_days))


def table_freshness(upload_log: DataFrame, wanted, databases, as_of: _dt.date,
                    lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """newest ``last_update_time`` per wanted ``schema.table`` within the look-back (None: ever).

    Columns of the log: ``db_name, schema_name, table_name, last_update_time``.
    Returns ``name, end_time``.
    """
    upload_log = _upload_log(upload_log)
    name = F.lower(F.concat(F.col("schema_name"), F.lit("."), F.col("table_name")))
    return (upload_log.where(_since("last_update_time", as_of, lookback_days)
                             & F.col("db_name").isin(list(databases))
                             & name.isin(_lower_list(wanted)))
            .groupBy(name.alias("name"))
            .agg(F.max("last_update_time").alias("end_time")))


def task_freshness(task_log: DataFrame, wanted, as_of: _dt.date, lookback_days: int | None = LOOKBACK_DAYS) -> DataFrame:
    """newest ``log_time`` of an ``end`` action per wanted ``db_schema.task`` within the look-back (None: ever).

    Columns of the log: ``db_schema, task, action, log_time``.
    """
    task_log = _task_log(task_log)
    name = F.lower(F.concat(F.col("db_schema"), F.lit("."), F.col("task")))
    return (task_log.where(_since("log_time", as_of, lookback_days) & (F.col("action") == "end")
                           & name.isin(_lower_list(wanted)))
            .groupBy(name.alias("name"))
            .agg(F.max("log_time").alias("end_time")))


# -- kept newest times -----------------------------------------------------------------
STATE_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("db_name", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("through", T.StringType()),       # last log partition in which the name had a row
])


def create_state(spark: SparkSession, state: str, root: str) -> None:
    """An empty state: a versioned table (``versions``) under ``root``."""
    versions.create_versioned(spark, state, STATE_SCHEMA, root)


def _advance(spark: SparkSession, state: str, root: str, rows: DataFrame, kind: str, partition_column: str) -> int:
    """rows (db_name, name, end_time, the log's partition column) of the log; partitions sort as text or dates do."""
    kept = spark.table(state)
    last = kept.where(F.col("kind") == kind).agg(F.max("through")).first()[0]
    if last is not None:
        rows = rows.where(F.col(partition_column) >= F.lit(last).cast(rows.schema[partition_column].dataType))
    rows = rows.select(F.lit(kind).alias("kind"), "db_name", "name", "end_time", F.col(partition_column).cast("string").alias("through"))
    merged = kept.unionByName(rows).groupBy("kind", "db_name", "name").agg(F.max("end_time").alias("end_time"), F.max("through").alias("through"))
    return versions.replace(spark, state, merged.select(*STATE_SCHEMA.fieldNames()).coalesce(1), root)


def advance_tables(spark: SparkSession, state: str, root: str, upload_log: DataFrame, partition_column: str) -> int:
    """Bring the state up to an upload log that is partitioned by ``partition_column`` in the order of time."""
    rows = _upload_log(upload_log, partition_column)
    name = F.lower(F.concat(F.col("schema_name"), F.lit("."), F.col("table_name")))
    rows = rows.where(name.isNotNull()).select("db_name", name.alias("name"), F.col("last_update_time").alias("end_time"), partition_column)
    return _advance(spark, state, root, rows, "table", partition_column)


def advance_tasks(spark: SparkSession, state: str, root: str, task_log: DataFrame, partition_column: str) -> int:
    """The same for a task log; only ``end`` actions count."""
    rows = _task_log(task_log, partition_column)
    name = F.lower(F.concat(F.col("db_schema"), F.lit("."), F.col("task")))
    rows = rows.where((F.col("action") == "end") & name.isNotNull()).select(
        F.lit(None).cast("string").alias("db_name"), name.alias("name"), F.col("log_time").alias("end_time"), partition_column)
    return _advance(spark, state, root, rows, "task", partition_column)


def kept_tables(state: DataFrame, wanted, databases) -> DataFrame:
    """F1 from the state: newest time ever per wanted name."""
    return (state.where((F.col("kind") == "table") & F.col("db_name").isin(list(databases)) & F.col("name").isin(_lower_list(wanted)))
            .groupBy("name").agg(F.max("end_time").alias("end_time")))


def kept_tasks(state: DataFrame, wanted) -> DataFrame:
    """F2 from the state."""
    return (state.where((F.col("kind") == "task") & F.col("name").isin(_lower_list(wanted)))
            .groupBy("name").agg(F.max("end_time").alias("end_time")))


def readiness(spark: SparkSession, fresh: DataFrame, wanted, as_of: _dt.date,
              kind: str = "table") -> DataFrame:
    """READY when the newest completion date reaches ``as_of``, WAITING
    when it is older, MISSING when the name has no log row at all."""
    names = spark.createDataFrame([(n,) for n in _lower_list(wanted)],
                                  T.StructType([T.StructField("name", T.StringType())]))
    end_date = F.to_date("end_time")
    status = (F.when(F.col("end_time").isNull(), F.lit(MISSING))
              .when(end_date >= F.lit(as_of), F.lit(READY))
              .otherwise(F.lit(WAITING)))
    return (F.broadcast(names).join(fresh, "name", "left")
            .select(F.lit(kind).alias("kind"), "name", "end_time", status.alias("status")))


def ready_gate(status: DataFrame) -> dict:
    """counts per status; raises when a wanted name is missing.

    Returns ``{"ready": n, "waiting": n, "proceed": bool}``; a scheduler polls
    this instead of sleeping inside the job.
    """
    row = status.agg(F.count_if(F.col("status") == READY).alias("ready"),
                     F.count_if(F.col("status") == WAITING).alias("waiting"),
                     F.count_if(F.col("status") == MISSING).alias("missing"),
                     F.min(F.when(F.col("status") == MISSING, F.col("name"))).alias("first_missing")
                     ).collect()[0]
    if row["missing"]:
        raise UpstreamMissing(f"Unable to get time for {row['first_missing']!r}")
    return {"ready": row["ready"], "waiting": row["waiting"], "proceed": row["waiting"] == 0}
