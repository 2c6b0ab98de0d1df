"""Checks that read new partitions only.

The scalar metrics of a stored table are kept as partial results for each partition directory
(``operators.partials``).  A run scans only directories that are new or have other files and merges the rest: counts
and sums add up, minima and maxima compare, averages are sums over counts.  The merged row then goes through the
suite's verdict plan, baselines included.

A rule set and filter have their own kept table (``state_name``), so a changed rule scans everything once.  Metrics that
cannot be merged (distinct counts, expressions around aggregates) are refused; run them with ``run_suite``.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..operators.partials import SCHEME, DirectoryPartials
from ..operators.results import VERDICT_COLUMNS, StoredResults, to_result
from ..spec import CheckConfigError, CheckSpec, TableRef
from . import suite as S

MERGEABLE = ("trending", "std_dev", "empty_null", "up_to_date", "compare_to_source")


def _partials(key: str, alias: str) -> tuple[list[tuple[str, str]], str]:
    """([(column, its aggregate over a partition)], the metric from the merged columns)."""
    kind, _, arg = key.partition(":")
    if kind == "count":
        return [(f"{alias}_n", "count(1)")], f"coalesce(sum({alias}_n), 0L)"
    if kind == "empty":
        return [(f"{alias}_s", S._empty_null_metric(arg))], f"sum({alias}_s)"
    if kind == "maxdate":
        return [(f"{alias}_m", f"max(to_date({arg}))")], f"max({alias}_m)"
    call = re.fullmatch(r"\s*(\w+)\s*\((.*)\)\s*", arg, re.DOTALL)
    name = call[1].lower() if call and S._single_call(arg) and not re.match(r"\s*(distinct|all)\b", call[2], re.IGNORECASE) else None
    if name == "count":
        return [(f"{alias}_n", arg)], f"coalesce(sum({alias}_n), 0L)"
    if name in ("sum", "min", "max"):
        return [(f"{alias}_v", arg)], f"{name}({alias}_v)"
    if name in ("avg", "mean"):
        return ([(f"{alias}_s", f"sum(CAST({call[2]} AS DOUBLE))"), (f"{alias}_n", f"count({call[2]})")],
                f"sum({alias}_s) / nullif(sum({alias}_n), 0L)")
    raise CheckConfigError(f"{arg!r} cannot be merged from partitions")


class IncrementalChecks:
    """Scalar rules over the Parquet table at ``path``, with partial results under ``root``.

    ``table`` is the three-part name that the verdicts carry; ``schema`` (by default that of the files) fixes the
    types of partition columns.  ``scanned`` holds the directories that the last run read.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, specs: list[CheckSpec], root: str, *, filter: str | None = None,
                 args: dict | None = None, schema: T.StructType | None = None, segment: str = ""):
        self.spark, self.path, self.root = spark, path.rstrip("/"), root.rstrip("/")
        self.specs = [s.bound(args) if args else s for s in specs if s.enabled]
        bad = [s.check_id for s in self.specs if s.family not in MERGEABLE]
        if bad:
            raise CheckConfigError(f"rules that cannot be merged from partitions: {bad}")
        self.table, self.filter, self.args, self.schema, self.segment = table, filter, args, schema, segment
        self.metrics, self.plan, self.sources, _ = S._metric_plan(self.specs, [])
        self.parts = {alias: _partials(key, alias) for key, alias in self.metrics.alias.items()}
        what = repr((table, self.path, filter, args, sorted(self.metrics.alias.items())))
        self.state_name = "tg_partials_" + hashlib.sha256(what.encode()).hexdigest()[:16]
        self.kept = DirectoryPartials(spark, self.state_name, f"{self.root}/{self.state_name}", self._read,
                                      [f"{sql} AS {name}" for made, _ in self.parts.values() for name, sql in made],
                                      lambda df: self._target(df).filtered())

    @property
    def scanned(self) -> list[str]:
        return self.kept.scanned

    def _read(self, directories: list[str] | None = None) -> DataFrame:
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        scheme = re.match(SCHEME, self.path)
        paths = [unquote((scheme[0] if scheme else "/") + d[1:]) for d in directories or ()]
        return reader.option("basePath", self.path).parquet(*(paths or [self.path]))

    def _target(self, df: DataFrame) -> TableRef:
        return TableRef(self.table, df, self.filter, self.args, self.segment)

    def partials(self) -> DataFrame:
        """Bring the kept partial results up to the table's files; returns them."""
        if self.schema is None:
            self.schema = self._read().schema
        return self.kept.current()

    def results(self, ctx: RunContext, history: DataFrame | StoredResults | None = None) -> DataFrame:
        """Result rows of the rules, as ``run_suite`` over the whole table gives them."""
        merged = self.partials().agg(*(F.expr(f"{final} AS {alias}") for alias, (_, final) in self.parts.items()))
        for name, src in self.sources.values():
            merged = merged.crossJoin(src.filtered().agg(F.count(F.lit(1)).alias(name)))       # 1 x 1
        target = self._target(self._read())
        suite = S.Suite(target, self.specs)
        rows = S._scalar_rows(merged, self.plan, {f.name: f.dataType for f in merged.schema.fields}, ctx)
        return to_result(S._finish_scalar(rows, suite, self.specs, ctx, history, self.spark).select(*VERDICT_COLUMNS), ctx)
