"""V5-V9 over stored tables: a kept table of newest verdicts.

The result table keeps every row ever written.  Reports need, for each run, the newest row of each rule, column
and day key; the kept table holds just those, with the result table's columns and partitioned by run date.  Each
run merges its rows into it: the keys it touches are looked up in the partitions of its own run dates, the newest
of the kept and the new row of each key wins (``results._newest_order``), and only partitions with a touched key
are rewritten.  ``verdicts``, ``rollup_day_to_day``, ``failures``, ``summary`` and ``stop_gate`` of ``results`` then
read the kept table: no checked table, and no row that a later one of the same run has replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import loads as L
from . import results as R

KEYS = ["dq_run_date", "dq_key", "database_name", "schema_name", "table_name", "env", "check_id", "dq_name", "dq_column"]


def newest(rows: DataFrame) -> DataFrame:
    """The newest row of each run, rule, column and day key; a partial aggregation, so a key with many rows does
    not gather in one task."""
    rest = [c for c in R.RESULT_COLUMNS if c not in KEYS]
    return (rows.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), R._newest_order()).alias("n"))
            .select(*(F.col(c) if c in KEYS else F.col(f"n.{c}").alias(c) for c in R.RESULT_COLUMNS)))


def _same_key(kept: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    keys = rows.select(*(F.col(c).alias(f"_tg_{c}") for c in KEYS)).distinct()
    return kept.join(keys, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_tg_{c}")) for c in KEYS]), how)


def keep_newest(spark: SparkSession, rows: DataFrame, table: str, staging: str, resume: bool = False) -> int:
    """Merge a run's result rows, as they were appended, into the kept table (of ``results.create_results``).
    Returns the number of partitions rewritten.  Merging rows twice changes nothing; a stopped call is finished by
    the same call with ``resume=True``."""
    rows = R.conform(rows)
    dates = [r[0] for r in rows.select("dq_run_date").distinct().collect()]       # one date for each run
    kept = spark.table(table).where(F.col("dq_run_date").isin([d for d in dates if d is not None])
                                    | (F.col("dq_run_date").isNull() & F.lit(None in dates)))
    merged = newest(_same_key(kept.select(*R.RESULT_COLUMNS), rows, "left_semi").unionByName(rows))
    return L._rewrite_partitions(spark, table, merged, lambda tgt: _same_key(tgt, rows, "left_semi"),
                                 lambda tgt: _same_key(tgt, rows, "left_anti"), staging, resume)


def kept_results(spark: SparkSession, table: str) -> DataFrame:
    """The kept rows, for the reports of ``results``."""
    return R.conform(spark.table(table))
