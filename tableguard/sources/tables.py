"""Readers and derived inputs.

``read_table`` reads one Parquet table of a directory.  ``daily_history``
derives result-table rows from a table's own per-day aggregate: each earlier
day ``d`` becomes a run at ``d + hour`` that recorded that day's value.  The
tests and the registered queries use it to give trending / std_dev a history
that grows with the data; it is a plain ``groupBy(date)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.results import RESULT_SCHEMA


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def daily_history(df: DataFrame, date_expr: str, metrics: dict[str, str], table: str,
                  dq_name: str, *, before: _dt.date, env: str, hour: int = 6,
                  check_id: str | None = None) -> DataFrame:
    """Result rows for every day before ``before``: one per (day, metric).

    ``metrics`` maps the stored ``dq_column`` text to the Spark aggregate that
    computes it.  The run key of a day is its epoch second.
    """
    from ..functions import sql as Q
    db, schema, tbl = table.split(".")
    names = list(metrics)
    day = f"to_date({date_expr})"
    agg = (df.where(f"{day} < DATE'{before.isoformat()}'").groupBy(F.expr(f"{day} AS _d"))
           .agg(*[F.expr(f"CAST({metrics[n]} AS DOUBLE) AS _m{i}") for i, n in enumerate(names)]))
    pairs = ", ".join(f"named_struct('c', {Q.lit(n)}, 'v', _m{i})" for i, n in enumerate(names))
    rows = agg.selectExpr("_d", f"explode(array({pairs})) AS p")
    run_hour = f"to_timestamp_ntz(concat(CAST(_d AS STRING), ' {hour:02d}:00:00'))"
    vals = {
        "dq_run_hour": run_hour,
        "database_name": Q.lit(db),
        "schema_name": Q.lit(schema),
        "table_name": Q.lit(tbl),
        "table_filter": "''",
        "dq_name": Q.lit(dq_name),
        "dq_column": "p.c",
        "dq_description": "'derived daily history'",
        "dq_tgt_value": Q.num_text("p.v"),
        "dq_src_value": "NULL",
        "dq_threshold": "NULL",
        "is_pass": "true",
        "stop_on_failure": "false",
        "is_dq_custom": "false",
        "dq_key": f"CAST(datediff(_d, DATE'1970-01-01') AS BIGINT) * 86400 + {hour * 3600}",
        "dq_start_tstamp": run_hour,
        "dq_end_tstamp": run_hour,
        "db_username": "''",
        "unix_username": "''",
        "env": Q.lit(env),
        "is_trial": "false",
        "check_id": Q.lit(check_id or dq_name),
        "dq_tgt_num": "p.v",
        "rule_column": "p.c",
        "dq_run_date": "_d",
    }
    return rows.selectExpr(*[f"CAST({vals[f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
                             for f in RESULT_SCHEMA.fields])
