"""An isolated run.

A trial reads its baselines from the permanent result table and writes to a scratch table of its own, so no later
run compares with it.  Its weekly-band rules are seeded first: the last nine weeks of the permanent ``trending``
rows of their columns are copied into the scratch table as ``std_dev`` history.  ``overlay`` shows a scratch table
on top of the permanent one, for a trial that continues an earlier one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..context import RunContext
from ..operators import history as H
from ..operators import results as R
from .suite import Suite, run_suite


def seeds(suites: list[Suite], ctx: RunContext, history: DataFrame | R.StoredResults) -> DataFrame | None:
    """The rows that seed the weekly-band rules of the suites, or None without such rules."""
    wanted: dict[tuple, set[str]] = {}
    for suite in suites:
        for s in suite.specs:
            if s.enabled and s.family == "std_dev":
                wanted.setdefault(suite.target.parts, set()).update(s.columns)
    parts = [H.seed_std_dev(history, *series, sorted(columns), ctx) for series, columns in wanted.items()]
    return reduce(DataFrame.unionByName, parts) if parts else None


def isolated_run(spark: SparkSession, suites: Suite | list[Suite], ctx: RunContext,
                 history: DataFrame | R.StoredResults, sink: str | None = None, seed: bool = True) -> DataFrame:
    """Run the suites against ``history``, write verdicts and seeded rows to ``sink`` (by default the run's place
    in the shared folder) in one append, and return the rows of the sink.  ``history`` is only read."""
    suites = [suites] if isinstance(suites, Suite) else suites
    sink = sink or R.scratch_results_path(spark, ctx.dq_key)
    rows = run_suite(spark, suites, ctx, history)
    seeded = seeds(suites, ctx, history) if seed else None
    R.append_results(rows if seeded is None else rows.unionByName(seeded), sink)
    return R.read_results(spark, sink)


def overlay(history: DataFrame | R.StoredResults, scratch: R.StoredResults) -> DataFrame | R.StoredResults:
    """The rows of a scratch table on top of the permanent history, as the history of a further trial."""
    frame = H.frame_of(history).unionByName(scratch.frame)
    if not isinstance(history, R.StoredResults):
        return frame
    return R.StoredResults(frame, sorted({*history.dates, *scratch.dates}, reverse=True))
