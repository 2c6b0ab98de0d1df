"""Readers for the two upstream logs readiness is computed from.

Both are event tables; the readers only select and type the columns the
freshness operators use (so a wider log is pruned at the scan) and fail early
when one is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of the upload log and of the task log.
UPLOAD_LOG_COLUMNS = {"db_name": "string", "schema_name": "string", "table_name": "string",
                      "last_update_time": "timestamp_ntz"}
TASK_LOG_COLUMNS = {"db_schema": "string", "task": "string", "action": "string",
                    "log_time": "timestamp_ntz"}


def _typed(df: DataFrame, columns: dict[str, str], what: str, *also: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()], *also)


def upload_log(df: DataFrame, *also: str) -> DataFrame:
    """``db_name, schema_name, table_name, last_update_time`` and other columns as they are."""
    return _typed(df, UPLOAD_LOG_COLUMNS, "upload log", *also)


def task_log(df: DataFrame, *also: str) -> DataFrame:
    """``db_schema, task, action, log_time`` and other columns as they are."""
    return _typed(df, TASK_LOG_COLUMNS, "task log", *also)
