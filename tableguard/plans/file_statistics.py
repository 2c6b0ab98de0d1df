"""Checks answered from file statistics.

A Parquet file's footer holds its row count, the null count of each column and its smallest and largest value.
Rules whose metrics are ``count(*)``, ``count(column)``, ``min`` and ``max`` of whole numbers and dates (``up_to_date``
and ``compare_to_source`` among them), over a whole table or whole partitions, therefore need no row at all.
Spark's Parquet reader of the second kind takes such aggregates; where one metric or the filter does not allow it,
the same statement reads rows.

The one row of metrics is fetched first, as ``observe`` does it for loads.  Footers may lack a value that
Spark only finds missing while it runs (a column without a value in one row group, a writer that keeps no
statistics); the statement is then run once more over rows, so the verdicts are those of ``run_suite``.  Smallest
and largest floats are always read from rows.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..operators.results import VERDICT_COLUMNS, StoredResults, to_result
from ..spec import CheckConfigError, CheckSpec, TableRef
from . import suite as S

READERS, PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
FAMILIES = ("trending", "std_dev", "empty_null", "up_to_date", "compare_to_source")


@contextmanager
def _pushing(spark: SparkSession, on: bool):
    old = {key: spark.conf.get(key) for key in (READERS, PUSHDOWN)}
    if on:
        spark.conf.set(READERS, ",".join(x for x in old[READERS].split(",") if x.strip() != "parquet"))
    spark.conf.set(PUSHDOWN, str(on).lower())
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


class StatisticsChecks:
    """Scalar rules over the Parquet table at ``path``, named ``table`` in the verdicts.

    ``schema`` (by default that of the files) fixes the types of partition columns.  After ``results``,
    ``from_footers`` tells whether the metrics came without reading rows.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, specs: list[CheckSpec], *, filter: str | None = None,
                 args: dict | None = None, schema: T.StructType | None = None, segment: str = ""):
        self.spark, self.path, self.schema = spark, path, schema
        self.specs = [s.bound(args) if args else s for s in specs if s.enabled]
        bad = [s.check_id for s in self.specs if s.family not in FAMILIES]
        if bad:
            raise CheckConfigError(f"rules without scalar metrics: {bad}")
        self.table, self.filter, self.args, self.segment = table, filter, args, segment
        self.metrics, self.plan, self.sources, _ = S._metric_plan(self.specs, [])
        self.from_footers: bool | None = None

    def target(self) -> TableRef:
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return TableRef(self.table, reader.parquet(self.path), self.filter, self.args, self.segment)

    def metric_row(self) -> DataFrame:
        """The statement of the metrics; its plan shows ``PushedAggregation`` where footers answer it."""
        return S._one_row(self.target().filtered(), self.metrics)

    def _unsure(self, row: DataFrame) -> bool:
        """Whether footers may tell another value than the rows: some writers leave NaN out of them."""
        return any(isinstance(row.schema[alias].dataType, (T.FloatType, T.DoubleType)) and re.match(r"expr:\s*(min|max)\b", key, re.IGNORECASE)
                   for key, alias in self.metrics.alias.items())

    def _fetched(self) -> tuple[T.StructType, list]:
        with _pushing(self.spark, True):
            row = self.metric_row()
            scans = re.findall(r"PushedAggregation: \[(.*?)\]", row._jdf.queryExecution().executedPlan().toString())
            self.from_footers = bool(scans) and all(scans)
            if not self._unsure(row):
                try:
                    rows = row.collect()
                    if not any(v is None and not f.nullable for f, v in zip(row.schema.fields, rows[0])):
                        return row.schema, rows             # without a row group, counts come as NULL
                except (PySparkException, Py4JJavaError):       # any other fault comes up again below
                    if not self.from_footers:
                        raise
        with _pushing(self.spark, False):
            self.from_footers = False
            row = self.metric_row()
            return row.schema, row.collect()

    def results(self, ctx: RunContext, history: DataFrame | StoredResults | None = None) -> DataFrame:
        """Result rows of the rules, as ``run_suite`` over the table gives them."""
        schema, rows = self._fetched()
        merged = self.spark.createDataFrame(rows, schema)
        for name, src in self.sources.values():
            merged = merged.crossJoin(src.filtered().agg(F.count(F.lit(1)).alias(name)))       # 1 x 1
        suite = S.Suite(self.target(), self.specs)
        verdicts = S._scalar_rows(merged, self.plan, {f.name: f.dataType for f in merged.schema.fields}, ctx)
        return to_result(S._finish_scalar(verdicts, suite, self.specs, ctx, history, self.spark).select(*VERDICT_COLUMNS), ctx)
