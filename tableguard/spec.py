"""Declarative check specifications and their validation.

A ``CheckSpec`` is one rule of a suite (one family, one or more columns).
A ``TableRef`` names the table a suite checks and carries its DataFrame and
optional row filter.  ``Threshold`` parses the threshold text once, so the
verdict code never looks at strings.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The check families and their name rules.
FAMILIES = (
    "trending",
    "compare_to_source",
    "empty_null",
    "unique",
    "up_to_date",
    "day_to_day",
    "missing_dates",
    "std_dev",
    "custom",
)
# Families whose rule name may carry a suffix (``trending_week``, ``std_dev_up``).
PREFIX_FAMILIES = ("trending", "std_dev")
COMPARE_TYPES = (None, "day", "week", "month", "year")
MAX_NUM_DAYS = 30
RELATIVE_LIMIT = 1.0
STD_DEV_LIMIT = 10.0
DEFAULT_WINDOW = 90


class CheckConfigError(ValueError):
    """A rule that the suite refuses to run."""


def family_of(name: str) -> str:
    for fam in PREFIX_FAMILIES:
        if name.startswith(fam):
            return fam
    if name in FAMILIES and name != "custom":
        return name
    raise CheckConfigError(f"Unknown generic check name: {name!r}")


def _literal(value) -> str:
    """SQL literal of a parameter value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP'{value.isoformat(' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"({value})" if value < 0 else str(value)     # bare, ``a-:x`` would become a comment


def bind(text: str, args: dict) -> str:
    """``text`` with its ``:name`` markers of ``args`` as literals; quoted parts and ``::`` stay."""
    marker = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|::|:([A-Za-z_]\w*)")
    return marker.sub(lambda m: _literal(args[m[1]]) if m[1] in args else m[0], text)


@dataclass(frozen=True)
class Threshold:
    """Parsed threshold.

    mode: ``absolute`` | ``upward`` | ``downward`` | ``range``.
    ``value`` is the signed limit (negative for downward); ``low`` is the lower
    bound of a range.  ``text`` is what is stored in ``dq_threshold``.
    """

    mode: str
    value: float
    low: float | None = None
    text: str = "0"

    @classmethod
    def parse(cls, raw, *, mode: str | None = None, limit: float = RELATIVE_LIMIT,
              allow_range: bool = True) -> "Threshold":
        text = str(raw).strip()
        if mode is None:
            if "," in text:
                mode = "range"
            elif text.startswith("+"):
                mode = "upward"
            elif text.startswith("-"):
                mode = "downward"
            else:
                mode = "absolute"
        if mode == "range":
            if not allow_range:
                raise CheckConfigError("a range threshold is not accepted here")
            lo_txt, hi_txt = (p.strip() for p in text.split(",", 1))
            lo, hi = float(lo_txt), float(hi_txt)
            for v in (lo, hi):
                if abs(v) > limit:
                    raise CheckConfigError(f"threshold {v} outside [-{limit}, {limit}]")
            return cls("range", hi, lo, f"{lo_txt},{hi_txt}")
        try:
            v = float(text)
        except ValueError as exc:
            raise CheckConfigError(f"bad threshold {raw!r}") from exc
        if abs(v) > limit:
            raise CheckConfigError(f"threshold {v} outside [-{limit}, {limit}]")
        if mode == "upward":
            v = abs(v)
            if not text.startswith("+"):
                text = "+" + text
        elif mode == "downward":
            v = -abs(v)
            if not text.startswith("-"):
                text = "-" + text
        elif mode != "absolute":
            raise CheckConfigError(f"unknown threshold mode {mode!r}")
        return cls(mode, v, None, text)


@dataclass(frozen=True, eq=False)
class TableRef:
    """A checked table: three-part name, DataFrame and optional SQL filter.

    ``segment`` names the part of the table that the filter takes.  It is stored with the table's name
    (``table/segment``), so a segment has its own baselines, verdicts and gate from run to run, even when
    the filter's text holds the run's date.
    """

    name: str
    df: DataFrame
    filter: str | None = None
    args: dict | None = None
    segment: str = ""

    def __post_init__(self):
        if self.name.count(".") != 2:
            raise CheckConfigError(f"table name must be db.schema.table: {self.name!r}")

    @property
    def parts(self) -> tuple[str, str, str]:
        db, schema, table = self.name.split(".")
        return db, schema, f"{table}/{self.segment}" if self.segment else table

    def filtered(self) -> DataFrame:
        """The table after its filter; ``:name`` markers in the filter are
        bound from ``args`` as SQL parameters (never pasted as text)."""
        if not self.filter or self.filter.strip() in ("", "1=1"):
            return self.df
        if self.args:
            return self.df.sparkSession.sql(f"SELECT * FROM {{_tg_target}} WHERE {self.filter}",
                                            args=self.args, _tg_target=self.df)
        return self.df.where(F.expr(self.filter))

    @property
    def filter_text(self) -> str:
        # Stored as written, with the always-true default blanked.
        return (self.filter or "").replace("1=1", "")


@dataclass(frozen=True, eq=False)
class CheckSpec:
    """One rule.  Build with ``CheckSpec.make`` (validates and fills defaults)."""

    check_id: str
    family: str
    columns: tuple[str, ...] = ()
    threshold: Threshold = field(default_factory=lambda: Threshold("absolute", 0.0, None, "0"))
    description: str = ""
    stop_on_failure: bool = False
    is_trial: bool = False
    enabled: bool = True
    group_by: str | None = None
    num_days: int | None = None
    compare_type: str | None = None
    window: int = DEFAULT_WINDOW
    source: TableRef | None = None
    sql: str | Callable[..., DataFrame] | None = None
    args: dict | None = None
    frames: dict | None = None
    corrected: bool = False

    @property
    def dq_name(self) -> str:
        """Name written to ``dq_name``: the family, or the rule name for custom checks."""
        return self.check_id if self.family == "custom" else self.family

    @classmethod
    def make(cls, name: str, *, enabled: bool = True, columns=(), threshold=None,
             threshold_mode: str | None = None, description: str = "",
             stop_on_failure: bool = False, is_trial: bool = False,
             group_by: str | None = None, num_days: int | None = None,
             compare_type: str | None = None, window: int = DEFAULT_WINDOW,
             source: TableRef | None = None, family: str | None = None,
             corrected: bool = False) -> "CheckSpec":
        if enabled is None:
            raise CheckConfigError("'enabled' is mandatory")
        fam = family or family_of(name)
        if isinstance(columns, str):
            columns = (columns,)
        columns = tuple(columns)
        if fam == "std_dev":
            thr = Threshold.parse("1" if threshold is None else threshold,
                                  mode=threshold_mode, limit=STD_DEV_LIMIT, allow_range=False)
        elif fam in ("empty_null", "unique"):
            thr = Threshold("absolute", 0.0, None, "0")
        else:
            thr = Threshold.parse("0" if threshold is None else threshold,
                                  mode=threshold_mode, limit=RELATIVE_LIMIT)
        if fam != "compare_to_source" and not columns:
            raise CheckConfigError(f"{name}: columns are required")
        if fam == "compare_to_source":
            columns = ("count(*)",)
            if thr.mode == "range":
                # Only the upper bound limits the count ratio; it is what is stored.
                hi_text = thr.text.split(",", 1)[1].strip()
                thr = Threshold("absolute", thr.value, None, hi_text)
            if source is None:
                raise CheckConfigError("compare_to_source needs a source table")
        if fam == "day_to_day":
            if not group_by:
                raise CheckConfigError("day_to_day needs group_by")
            if num_days is None:
                raise CheckConfigError("day_to_day needs num_days")
            if int(num_days) > MAX_NUM_DAYS:
                raise CheckConfigError(f"num_days cannot exceed {MAX_NUM_DAYS}")
            num_days = int(num_days)
        if compare_type not in COMPARE_TYPES:
            raise CheckConfigError(f"unknown compare_type {compare_type!r}")
        if window < 1:
            raise CheckConfigError("window must be positive")
        return cls(check_id=name, family=fam, columns=columns, threshold=thr,
                   description=description, stop_on_failure=bool(stop_on_failure),
                   is_trial=bool(is_trial), enabled=bool(enabled), group_by=group_by,
                   num_days=num_days, compare_type=compare_type, window=window,
                   source=source, corrected=corrected)

    @classmethod
    def custom(cls, name: str, sql, *, args: dict | None = None, frames: dict | None = None,
               description: str = "",
               stop_on_failure: bool = False, is_trial: bool = False,
               enabled: bool = True) -> "CheckSpec":
        """User query returning ``tgt_value, src_value, result`` (0 = pass).

        ``sql`` is SQL text (named ``:param`` markers bound from ``args``;
        ``{name}`` placeholders bound to the DataFrames in ``frames``), a path
        ending in ``.sql``, or a callable ``SparkSession -> DataFrame``.
        """
        if sql is None:
            raise CheckConfigError("custom check needs sql, sql_file or a callable")
        return cls(check_id=name, family="custom", columns=("",), description=description,
                   stop_on_failure=bool(stop_on_failure), is_trial=bool(is_trial),
                   enabled=bool(enabled), sql=sql, args=args, frames=frames,
                   threshold=Threshold("absolute", 0.0, None, ""))

    def bound(self, args: dict) -> "CheckSpec":
        """The rule with the run's ``:name`` parameters as literals in its columns and group key, which are
        stored as they were run.  Custom SQL binds its parameters when it runs."""
        return replace(self, columns=tuple(bind(c, args) for c in self.columns),
                       group_by=bind(self.group_by, args) if self.group_by else self.group_by)

    def description_text(self) -> str:
        """Description as stored, with the suffixes the families append."""
        d = self.description
        if self.family == "trending" and self.compare_type:
            d += {"day": " (day-over-day)", "week": " (week-over-week)",
                  "month": " (month-over-month)", "year": " (year-over-year)"}[self.compare_type]
        if self.family == "day_to_day":
            d += f" [groupby ({self.group_by}) for {self.num_days} days]"
        return d


def rules_from_config(dq: dict | None, dq_custom: dict | None = None, *,
                      source: TableRef | None = None) -> list[CheckSpec]:
    """Rules from an already-parsed check configuration (the ``dq`` and
    ``dq_custom`` sections: rule name -> options), validated like ``make``.

    ``enabled`` is mandatory on every rule; disabled rules are kept with
    ``enabled=False``, also when they are not valid (the suite skips them).  Options: ``description``,
    ``threshold`` (``lo,hi`` for a range), ``columns``, ``stop_on_failure``,
    ``group_by``, ``num_days``, ``is_trial``, ``compare_type``; custom rules
    take ``sql`` or ``sql_file``.  ``source`` is the table compare_to_source
    reads.  Reading the configuration file itself is left to the caller.
    """
    specs: list[CheckSpec] = []
    for name, opts in (dq or {}).items():
        opts = dict(opts or {})
        if "enabled" not in opts:
            raise CheckConfigError(f"{name}: missing enabled option")
        try:
            specs.append(CheckSpec.make(
                name, enabled=opts["enabled"] is True, columns=opts.get("columns") or (),
                threshold=opts.get("threshold"), description=opts.get("description", ""),
                stop_on_failure=opts.get("stop_on_failure", False), is_trial=opts.get("is_trial", False),
                group_by=opts.get("group_by"), num_days=opts.get("num_days"),
                compare_type=opts.get("compare_type"),
                source=source if family_of(name) == "compare_to_source" else None))
        except CheckConfigError:
            if opts["enabled"] is True:
                raise
            specs.append(CheckSpec(name, name, enabled=False))
    for name, opts in (dq_custom or {}).items():
        opts = dict(opts or {})
        if "enabled" not in opts:
            raise CheckConfigError(f"{name}: missing enabled option")
        if opts["enabled"] is not True:
            specs.append(CheckSpec(name, "custom", enabled=False))
            continue
        sql = opts.get("sql_file") or opts.get("sql")
        if sql is None:
            raise CheckConfigError(f"{name}: no custom SQL or SQL file")
        specs.append(CheckSpec.custom(name, sql, description=opts.get("description", ""),
                                      stop_on_failure=opts.get("stop_on_failure", False),
                                      is_trial=opts.get("is_trial", False),
                                      enabled=opts["enabled"] is True))
    return specs
