"""Scalar checks observed while a load writes (no extra scan).

``DataFrame.observe`` evaluates named aggregates as a side effect of the
action that consumes the frame (the load's write), partially aggregated in
every task like any aggregate.  After the write, the single row of observed
metrics becomes the fused metric row of a suite and goes through the same
verdict plan (baselines, verdict R, band).  Only families whose metric is a
plain aggregate can be observed: trending, std_dev, empty_null, up_to_date
and compare_to_source (its source count is a separate one-row aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..operators.results import VERDICT_COLUMNS, to_result
from ..spec import CheckConfigError, CheckSpec, TableRef
from . import suite as S

OBSERVABLE = ("trending", "std_dev", "empty_null", "up_to_date", "compare_to_source")


class ObservedChecks:
    """Attach scalar rules to a frame that is about to be written.

    >>> oc = ObservedChecks("db.schema.orders", specs, ctx)
    >>> out = oc.attach(rows_to_load)     # then write ``out`` as usual
    >>> out.write...                      # the one action
    >>> verdicts = oc.results(spark, history)
    """

    def __init__(self, table: str, specs: list[CheckSpec], ctx: RunContext):
        self.specs = [s for s in specs if s.enabled]
        bad = [s.check_id for s in self.specs if s.family not in OBSERVABLE]
        if bad:
            raise CheckConfigError(f"rules that cannot be observed during a write: {bad}")
        self.table = table
        self.ctx = ctx
        self.metrics, self.plan, self.sources, _ = S._metric_plan(self.specs, [])
        self.observation = Observation(f"tableguard_{abs(hash((table, ctx.dq_key)))}")
        self._target: TableRef | None = None
        self._types: dict | None = None

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the metrics attached; write the returned frame."""
        self._target = TableRef(self.table, df)
        self._types = {f.name: f.dataType for f in df.agg(*self.metrics.cols.values()).schema.fields}
        return df.observe(self.observation, *self.metrics.cols.values())

    def results(self, spark: SparkSession, history: DataFrame | None = None) -> DataFrame:
        """Result rows of the rules, from the metrics the write observed."""
        if self._target is None:
            raise RuntimeError("attach() a frame and write it first")
        values = self.observation.get  # blocks until the observed action finished
        schema = T.StructType([T.StructField(n, t, True) for n, t in self._types.items()])
        agg = spark.createDataFrame([tuple(values.get(n) for n in self._types)], schema)
        for name, src in self.sources.values():
            agg = agg.crossJoin(src.filtered().agg(F.count(F.lit(1)).alias(name)))
        types = {f.name: f.dataType for f in agg.schema.fields}
        suite = S.Suite(self._target, self.specs)
        rows = S._scalar_rows(agg, self.plan, types, self.ctx)
        verdict = S._finish_scalar(rows, suite, self.specs, self.ctx, history, spark)
        return to_result(verdict.select(*VERDICT_COLUMNS), self.ctx)
