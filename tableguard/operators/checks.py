"""One function per check family.

Each builds a one-rule suite and returns its result rows; use
``plans.suite.run_suite`` with many rules to fuse their scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..context import RunContext
from ..plans.suite import Suite, run_suite
from ..spec import CheckSpec, TableRef


def _one(target: TableRef, spec: CheckSpec, ctx: RunContext, history: DataFrame | None = None) -> DataFrame:
    return run_suite(target.df.sparkSession, Suite(target, [spec]), ctx, history)


def trending(target: TableRef, history: DataFrame | None, columns, ctx: RunContext, threshold="0",
             compare_type: str | None = None, name: str = "trending", **kw) -> DataFrame:
    """Aggregate vs the newest earlier (or day/week/month/year-ago) value."""
    spec = CheckSpec.make(name, columns=columns, threshold=threshold, compare_type=compare_type, **kw)
    return _one(target, spec, ctx, history)


def compare_to_source(target: TableRef, source: TableRef, ctx: RunContext, threshold="0", **kw) -> DataFrame:
    """Row count of target vs source."""
    spec = CheckSpec.make("compare_to_source", threshold=threshold, source=source, **kw)
    return _one(target, spec, ctx)


def empty_null(target: TableRef, columns, ctx: RunContext, **kw) -> DataFrame:
    """C14: rows whose value is NULL or empty text, per column, one scan."""
    return _one(target, CheckSpec.make("empty_null", columns=columns, **kw), ctx)


def unique(target: TableRef, columns, ctx: RunContext, **kw) -> DataFrame:
    """Distinct vs total count per column (``a,b`` = composite key)."""
    return _one(target, CheckSpec.make("unique", columns=columns, **kw), ctx)


def up_to_date(target: TableRef, columns, ctx: RunContext, **kw) -> DataFrame:
    """Newest date of the column reaches ``as_of``."""
    return _one(target, CheckSpec.make("up_to_date", columns=columns, **kw), ctx)


def day_to_day(target: TableRef, columns, group_by: str, num_days: int, ctx: RunContext,
               threshold="0", **kw) -> DataFrame:
    """Neighbouring group keys compared with verdict R."""
    spec = CheckSpec.make("day_to_day", columns=columns, group_by=group_by, num_days=num_days,
                          threshold=threshold, **kw)
    return _one(target, spec, ctx)


def missing_dates(target: TableRef, columns, ctx: RunContext, window: int = 90, **kw) -> DataFrame:
    """C17: days without rows in the ``window`` days ending at the max date."""
    return _one(target, CheckSpec.make("missing_dates", columns=columns, window=window, **kw), ctx)


def std_dev(target: TableRef, history: DataFrame | None, columns, ctx: RunContext, threshold="1",
            name: str = "std_dev", **kw) -> DataFrame:
    """Aggregate inside the weekly band of earlier std_dev values."""
    spec = CheckSpec.make(name, columns=columns, threshold=threshold, **kw)
    return _one(target, spec, ctx, history)


def custom(target: TableRef, name: str, sql, ctx: RunContext, args: dict | None = None, **kw) -> DataFrame:
    """User query returning ``tgt_value, src_value, result``."""
    return _one(target, CheckSpec.custom(name, sql, args=args, **kw), ctx)
