"""Suite compiler: CheckSpecs + tables -> one DataFrame of result rows.

Plan shape per checked table (and filter):

* **Scalar metrics fused.** Every trending / std_dev aggregate, every
  empty/null count, every max date and the row count for compare_to_source are
  aliases ``m0..mk`` of ONE ``agg`` over the filtered table (one scan, partial
  aggregation per task, a single-row exchange).  The one-row result is turned
  into one row per (rule, column) with ``explode(array(struct...))``.
* **Filters of one table fused.** Suites over the same table (same plan by
  ``sameSemantics``) with different filters share one scan: built-in metrics become conditional
  aggregates, single-call free-text aggregates get ``FILTER (WHERE ...)``;
  their grouped metrics share one ``groupBy(key)`` with a conditional row
  count per filter.
* **Distinct keys** (unique): one ``groupBy(key)`` per column set, reading only
  those columns; partial aggregation collapses hot keys map-side.  No
  ``Expand`` multiplies the table by the number of columns.
* **Day metrics once** (missing_dates, day_to_day): one ``groupBy(key)`` per
  distinct key expression carries every day_to_day metric on that key and
  the present dates of a missing_dates column with the same day key; the
  max date comes from the fused aggregate.  day_to_day keeps the top keys
  (``TakeOrderedAndProject``) and applies ``lead`` over at most 30 rows;
  missing_dates joins the present dates to a broadcast spine of ``window``
  dates.  An aggregate read by several branches (one row, or one row per
  key) is one reused exchange, so the table is scanned once for all of them.
* **Baselines**: one set-based lookup over the history table per family,
  joined to the exploded rows on ``(check_id, dq_column)``.

Everything is unioned and stamped with the run context; the caller appends
the result once.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..functions import concat_key
from ..functions import sql as Q
from ..operators import history as H
from ..operators import results as R
from ..operators.results import to_result
from ..spec import CheckConfigError, CheckSpec, TableRef, bind

SCALAR_FAMILIES = ("trending", "std_dev", "compare_to_source", "empty_null", "up_to_date")

# Fields of the per-row struct produced from the fused one-row aggregate.
_ROW = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("dq_column", T.StringType()),
    T.StructField("dq_description", T.StringType()),
    T.StructField("tgt_num", T.DoubleType()),
    T.StructField("tgt_text", T.StringType()),
    T.StructField("src_num", T.DoubleType()),
    T.StructField("src_text", T.StringType()),
    T.StructField("dq_threshold", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("t_value", T.DoubleType()),
    T.StructField("t_low", T.DoubleType()),
    T.StructField("pre_pass", T.BooleanType()),
    T.StructField("stop_on_failure", T.BooleanType()),
    T.StructField("is_trial", T.BooleanType()),
])


_TYPE_NAMES = {f.name: f.dataType.simpleString() for f in _ROW.fields}


@dataclass
class Suite:
    """Rules bound to one table."""

    target: TableRef
    specs: list[CheckSpec]

    def __post_init__(self):
        ids = [s.check_id for s in self.specs if s.enabled and s.family in ("trending", "std_dev")]
        twice = sorted({i for i in ids if ids.count(i) > 1})
        if twice:
            raise CheckConfigError(f"ids of rules with a baseline must be unique in a suite: {twice}")
        if self.target.args:
            self.specs = [s.bound(self.target.args) for s in self.specs]


def _row(spec: CheckSpec, column: str, *, tgt_num="NULL", tgt_text="NULL", src_num="NULL",
         src_text="NULL", threshold=None, pre_pass="NULL") -> str:
    """SQL ``named_struct`` of one result row (operands are SQL text)."""
    thr = spec.threshold
    t_value = thr.value
    if spec.family == "std_dev" and spec.corrected:
        t_value = abs(t_value)
    vals = {
        "check_id": Q.lit(spec.check_id),
        "family": Q.lit(spec.family),
        "dq_column": Q.lit(column),
        "dq_description": Q.lit(spec.description_text()),
        "tgt_num": tgt_num,
        "tgt_text": tgt_text,
        "src_num": src_num,
        "src_text": src_text,
        "dq_threshold": Q.lit(thr.text) if threshold is None else threshold,
        "mode": Q.lit(thr.mode),
        "t_value": Q.lit(float(t_value)),
        "t_low": Q.lit(None if thr.low is None else float(thr.low)),
        "pre_pass": pre_pass,
        "stop_on_failure": Q.lit(spec.stop_on_failure),
        "is_trial": Q.lit(spec.is_trial),
    }
    return "named_struct(" + ", ".join(
        f"'{f.name}', CAST({vals[f.name]} AS {_TYPE_NAMES[f.name]})" for f in _ROW.fields) + ")"


class _Metrics:
    """Deduplicating registry of aggregate columns for the fused scan."""

    def __init__(self):
        self.cols: dict[str, Column] = {}
        self.alias: dict[str, str] = {}

    def add(self, key: str, sql_text: str) -> str:
        """Register the aggregate ``sql_text`` (SQL) under ``key``; returns its alias."""
        if key not in self.alias:
            name = f"m{len(self.alias)}"
            self.alias[key] = name
            self.cols[name] = F.expr(f"{sql_text} AS {name}")
        return self.alias[key]


def _empty_null_metric(column: str) -> str:
    return f"sum(CASE WHEN length(CAST(({column}) AS STRING)) = 0 OR ({column}) IS NULL THEN 1 ELSE 0 END)"


def _date_metric_key(column: str) -> str:
    return "maxdate:" + column


def _fused_metrics(suite: Suite, specs: list[CheckSpec], date_columns: list[str],
                   shared: "_SharedScan | None" = None):
    """The one-row aggregate of every scalar metric of the suite (one scan).

    ``date_columns`` are the missing_dates columns: their max date is a
    metric here too, so the date spine needs no scan of its own.  With
    ``shared``, the metrics come from the scan shared with other filters of
    the same table.  Returns ``(agg, plan, types, dates)``; ``plan`` lists
    ``(spec, column, alias)``.
    """
    metrics, plan, sources, dates = _metric_plan(specs, date_columns)
    if shared is not None:
        agg = shared.agg_for(suite, metrics)
    else:
        agg = _one_row(suite.target.filtered(), metrics)
    for name, src in sources.values():
        # One-row frames: the cross join is a 1 x 1 broadcast nested loop.
        agg = agg.crossJoin(src.filtered().agg(F.count(F.lit(1)).alias(name)))
    types = {f.name: f.dataType for f in agg.schema.fields}
    return agg, plan, types, dates


def _one_row(df: DataFrame, metrics: _Metrics) -> DataFrame:
    """All metrics as one row.  Each metric with a DISTINCT is an aggregate of its own: several in one
    aggregate would plan an ``Expand`` that copies every row once for each distinct column."""
    apart = [a for k, a in metrics.alias.items() if re.search(r"\bdistinct\b", k, re.IGNORECASE)]
    rest = [c for a, c in metrics.cols.items() if a not in apart]
    rows = ([df.agg(*rest)] if rest else []) + [df.agg(metrics.cols[a]) for a in apart]
    return reduce(lambda a, b: a.crossJoin(b), rows)    # 1 x 1


def _metric_plan(specs: list[CheckSpec], date_columns: list[str]):
    """Aggregate columns (deduplicated) for the scalar rules, and which rule
    row reads which alias."""
    metrics = _Metrics()
    plan = []  # (spec, column, metric name(s))
    sources: dict[int, tuple[str, TableRef]] = {}
    for spec in specs:
        for column in spec.columns:
            if spec.family in ("trending", "std_dev"):
                plan.append((spec, column, metrics.add("expr:" + column, column)))
            elif spec.family == "compare_to_source":
                m = metrics.add("count", "count(1)")
                sid = id(spec.source)
                if sid not in sources:
                    sources[sid] = (f"s{len(sources)}", spec.source)
                plan.append((spec, column, (m, sources[sid][0])))
            elif spec.family == "empty_null":
                plan.append((spec, column, metrics.add("empty:" + column, _empty_null_metric(column))))
            elif spec.family == "up_to_date":
                plan.append((spec, column, metrics.add(_date_metric_key(column), f"max(to_date({column}))")))
    dates = {c: metrics.add(_date_metric_key(c), f"max(to_date({c}))") for c in date_columns}
    return metrics, plan, sources, dates


def _filterable(df: DataFrame, text: str) -> bool:
    """True when ``text`` is one call of an aggregate function, so that ``text FILTER (WHERE p)`` filters
    the whole expression.  Spark's analysis decides whether the function is an aggregate."""
    if not _single_call(text):
        return False
    try:
        df.selectExpr(f"{text} FILTER (WHERE true)")
    except AnalysisException:   # a wrapped aggregate, as coalesce(sum(v), 0)
        return False
    return True


def _single_call(text: str) -> bool:
    """True when ``text`` is one function call ``f(...)`` and nothing else."""
    m = re.match(r"\s*[A-Za-z_][A-Za-z0-9_]*\s*\(", text)
    if not m:
        return False
    depth, quote = 0, None
    for i in range(m.end() - 1, len(text)):
        ch = text[i]
        if quote:
            if ch == quote:
                quote = None
            continue
        if ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return text[i + 1:].strip() == ""
    return False


def _conditional(key: str, filt: str | None, df: DataFrame) -> str | None:
    """The metric ``key`` restricted to rows where ``filt`` holds (NULL = no),
    as SQL.  Empty inputs keep their meaning: a conditional sum over no
    matching row is NULL, a conditional count is 0.  ``None`` when it cannot
    be expressed (a compound free-text aggregate)."""
    kind, _, arg = key.partition(":")
    when = (lambda v: v) if not filt else (lambda v: f"CASE WHEN ({filt}) THEN {v} END")
    if kind == "count":
        return f"count({when('1')})"
    if kind == "empty":
        hit = f"CASE WHEN length(CAST(({arg}) AS STRING)) = 0 OR ({arg}) IS NULL THEN 1 ELSE 0 END"
        return f"sum({when(hit)})"
    if kind == "maxdate":
        return f"max({when(f'to_date({arg})')})"
    if not filt:
        return arg
    if _filterable(df, arg):
        return f"{arg} FILTER (WHERE {filt})"
    return None


_MASK_BITS = 62      # filters in one BIGINT


def _distinct_keys(key: str) -> tuple[str, ...] | None:
    """The key expressions of a metric that is one ``count(DISTINCT ...)``."""
    kind, _, text = key.partition(":")
    m = re.fullmatch(r"\s*count\s*\(\s*distinct\b(.*)\)\s*", text, re.IGNORECASE | re.DOTALL)
    return tuple(Q.split_top_level(m[1])) if kind == "expr" and m and _single_call(text) else None


class _SharedScan:
    """Scalar metrics of several suites over ONE table with different filters.

    One scan (pre-filtered by the OR of the filters, which Parquet pushdown
    still uses) computes every suite's built-in metrics as conditional
    aggregates and every single-call free-text aggregate with
    ``FILTER (WHERE ...)``; ``count(DISTINCT ...)`` comes from one
    ``groupBy(keys)`` with the bits of the filters that each key meets; compound free-text aggregates come from one
    ``groupBy(filter id)`` over rows tagged with the filters they match.  Every suite reads the shared rows
    (see ``_shared``).
    """

    def __init__(self, suites: list[Suite]):
        self.suites = suites
        cols: dict[tuple[str | None, str], str] = {}
        self.map: dict[int, dict[str, str]] = {}
        self.own: dict[int, list[str]] = {}
        self.counted: dict[tuple[str, ...], dict[str | None, str]] = {}
        built: list[Column] = []
        for suite in suites:
            specs = [s for s in suite.specs if s.enabled and s.family in SCALAR_FAMILIES]
            dates = [c for s in suite.specs if s.enabled and s.family == "missing_dates" for c in s.columns]
            metrics, _, _, _ = _metric_plan(specs, dates)
            filt = _filter_text(suite)
            m, own = {}, []
            for key, alias in metrics.alias.items():
                ck = (filt, key)
                if ck not in cols:
                    counted = _distinct_keys(key)
                    col = None if counted else _conditional(key, filt, suites[0].target.df)
                    if col is None and not counted or col and re.search(r"\bdistinct\b", col, re.IGNORECASE):
                        own.append(key)
                        continue
                    cols[ck] = f"c{len(cols)}"
                    if counted:
                        self.counted.setdefault(counted, {})[filt] = cols[ck]
                    else:
                        built.append(F.expr(f"{col} AS {cols[ck]}"))
                m[alias] = cols[ck]
            self.map[id(suite)] = m
            self.own[id(suite)] = own
        df = suites[0].target.df
        filters = [_filter_text(x) for x in suites]
        if all(filters):
            df = df.where(" OR ".join(f"coalesce(({f}), false)" for f in filters))
        self.agg = _shared(df.agg(*built), one_row=True) if built else None
        self.distinct = self._distinct_by_filter(df)
        self.compound = self._compound_by_filter(suites, df)
        keyed = [x for x in suites if _keyed_needs(x)]
        self.keyed = _SharedKeyed(keyed, df) if len(keyed) > 1 else None
        self.uniques = self._unique_counts(suites, df)

    def _distinct_by_filter(self, df: DataFrame) -> dict[str, DataFrame]:
        """Counts of distinct keys under several filters: one ``groupBy(keys)`` gathers the bits of the filters that
        some row of the key meets, and one global aggregate counts the keys of each bit.  One shuffle whatever
        the number of filters, and no ``Expand``.  Returns ``{alias: one-row frame}``."""
        out = {}
        for keys, by_filter in self.counted.items():
            names = [f"_k{i}" for i in range(len(keys))]
            masks = [list(by_filter.items())[lo:lo + _MASK_BITS] for lo in range(0, len(by_filter), _MASK_BITS)]
            bits = [" + ".join(f"CASE WHEN {f'coalesce(({f}), false)' if f else 'true'} THEN {1 << i}L ELSE 0L END"
                               for i, (f, _) in enumerate(mask)) for mask in masks]
            rows = df.selectExpr(*(f"{k} AS {n}" for k, n in zip(keys, names)), *(f"{b} AS _b{j}" for j, b in enumerate(bits)))
            rows = rows.where(" AND ".join(f"{n} IS NOT NULL" for n in names))
            met = rows.groupBy(*names).agg(*(F.bit_or(f"_b{j}").alias(f"_b{j}") for j in range(len(masks))))
            row = _shared(met.agg(*(F.expr(f"count_if(_b{j} & {1 << i}L <> 0) AS {alias}")
                                    for j, mask in enumerate(masks) for i, (_, alias) in enumerate(mask))), one_row=True)
            out |= dict.fromkeys(by_filter.values(), row)
        return out

    def _compound_by_filter(self, suites: list[Suite], df: DataFrame):
        """Compound free-text aggregates (no single ``FILTER`` applies) of the
        filtered suites: each row is tagged with the filters it matches
        (``explode``; a row is repeated at most once per matching filter, a
        configuration bound) and ONE ``groupBy(filter id)`` computes them all.
        Returns ``{id(suite): (filter id, {metric key: alias})}`` and keeps the
        grouped frame (one row per filter) for all suites."""
        fids, cols, out = [], [], {}
        for suite in suites:
            own = self.own[id(suite)]
            filt = _filter_text(suite)
            if not own or not filt:
                continue
            i = len(fids)
            fids.append(filt)
            names = {}
            for key in own:
                names[key] = f"x{i}_{len(names)}"
                cols.append(F.expr(f"{key.partition(':')[2]} AS {names[key]}"))
            out[id(suite)] = (i, names)
        if not out:
            return {}
        tags = ", ".join(f"CASE WHEN coalesce(({f}), false) THEN {i} END" for i, f in enumerate(fids))
        tagged = df.selectExpr("*", f"explode(array({tags})) AS _fid").where("_fid IS NOT NULL")
        self.compound_frame = _shared(tagged.groupBy("_fid").agg(*cols))
        return out

    def _unique_counts(self, suites: list[Suite], df: DataFrame) -> dict:
        """Distinct/total counts of every unique key set of every filter.

        Per key set: one ``groupBy(keys)`` with a conditional row count per
        filter, then ONE global aggregate giving each filter's distinct and
        total counts (a shared one-row result).
        Returns ``{(id(suite), column): (one_row_frame, distinct_alias, total_alias)}``.
        """
        sets: dict[str, list[tuple[Suite, str]]] = {}
        for suite in suites:
            for spec in suite.specs:
                if spec.enabled and spec.family == "unique":
                    for c in spec.columns:
                        sets.setdefault(re.sub(r"\s+", "", c.lower()), []).append((suite, c))
        out = {}
        for members in sets.values():
            if len({_filter_text(su) for su, _ in members}) < 2:
                continue
            parts = Q.split_top_level(members[0][1])
            keys = [f"_k{i}" for i in range(len(parts))]
            complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            counts, stats, flags, seen = [], [], [], {}
            for su, c in members:
                f = _filter_text(su)
                if f not in seen:
                    i = len(seen)
                    seen[f] = i
                    flags.append(f"coalesce(({f}), false) AS _f{i}" if f else f"true AS _f{i}")
                    counts.append(F.expr(f"count(CASE WHEN _f{i} THEN 1 END) AS _n{i}"))
                    stats += [F.expr(f"count_if({complete} AND _n{i} > 0) AS _d{i}"),
                              F.expr(f"coalesce(sum(_n{i}), 0L) AS _t{i}")]
            projected = df.selectExpr(*[f"{p} AS {k}" for p, k in zip(parts, keys)], *flags)
            grouped = projected.groupBy(*keys).agg(*counts)
            row = _shared(grouped.agg(*stats), one_row=True)
            for su, c in members:
                i = seen[_filter_text(su)]
                out[(id(su), c)] = (row, f"_d{i}", f"_t{i}")
        return out

    def agg_for(self, suite: Suite, metrics: _Metrics) -> DataFrame:
        m = self.map[id(suite)]
        rows: dict[int, tuple[DataFrame, list[str]]] = {}
        for alias, c in m.items():
            frame = self.distinct.get(c, self.agg)
            rows.setdefault(id(frame), (frame, []))[1].append(f"{c} AS {alias}")
        parts = [frame.selectExpr(*columns) for frame, columns in rows.values()]
        own_keys = self.own[id(suite)]
        if own_keys and id(suite) in self.compound:
            i, names = self.compound[id(suite)]
            got = (self.compound_frame.where(f"_fid = {i}")
                   .selectExpr(*[f"{names[k]} AS {metrics.alias[k]}" for k in own_keys], "1 AS _p"))
            # a filter with no row: the aggregates' empty-input values (no scan: limit 0)
            empty = (suite.target.df.limit(0).agg(*[metrics.cols[metrics.alias[k]] for k in own_keys])
                     .selectExpr("*", "0 AS _p"))
            parts.append(got.unionByName(empty).orderBy(F.col("_p").desc()).limit(1).drop("_p"))
        elif own_keys:
            parts.append(suite.target.filtered().agg(*[metrics.cols[metrics.alias[k]] for k in own_keys]))
        return reduce(lambda a, b: a.crossJoin(b), parts)


def _keyed_needs(suite: Suite) -> list[tuple[str, Column, str | None]]:
    """(key text, key column, metric or None) of every grouped rule of a suite."""
    needs = []
    for s in suite.specs:
        if not s.enabled:
            continue
        if s.family == "day_to_day":
            text, key = _day_key(s)
            needs += [(text, key, c) for c in s.columns]
        elif s.family == "missing_dates":
            needs += [(*_date_key(suite, c), None) for c in s.columns]
    return needs


class _SharedKeyed:
    """Grouped (per-key) metrics of several filters of one table in one scan.

    For every key expression: one ``groupBy(key)`` over the pre-filtered
    table; per filter a conditional row count (does this filter have the
    key?) and its day_to_day metrics with ``FILTER (WHERE ...)``.  A suite
    with a compound metric that cannot be filtered keeps its own groupBy.
    """

    def __init__(self, suites: list[Suite], df: DataFrame):
        self.df = df
        self.keys: dict[str, Column] = {}
        self.aliases: dict[str, dict[tuple, str]] = {}
        self.exprs: dict[str, list[Column]] = {}
        self.map: dict[int, dict[str, dict[str, str]]] = {}
        self._frames: dict[str, DataFrame] = {}
        if any(_filter_text(x) and any(m and not _filterable(df, m) for _, _, m in _keyed_needs(x))
               for x in suites):
            # one suite needs the (key, filter id) grouping: all use it, one groupBy per key
            self.map = {}
            self._tagging(suites)
            return
        for suite in suites:
            filt = _filter_text(suite)
            needs = _keyed_needs(suite)
            mp: dict[str, dict[str, str]] = {}
            for text, key, metric in needs:
                k = _norm_key(text)
                self.keys.setdefault(k, key)
                entry = mp.setdefault(k, {"rows": self._add(k, filt, "rows",
                                                            f"count(CASE WHEN ({filt}) THEN 1 END)"
                                                            if filt else "count(1)")})
                if metric:
                    entry[metric] = self._add(k, filt, "expr:" + metric,
                                              f"{metric} FILTER (WHERE {filt})" if filt else metric)
            self.map[id(suite)] = mp
        self._tagging([])

    def _tagging(self, suites: list[Suite]) -> None:
        """Suites with a compound grouped metric (no single ``FILTER``): rows
        are tagged with the filters they match and grouped by (key, filter id),
        so each filter gets exactly the groups of its own ``groupBy``."""
        self.tag_ids: dict[int, int] = {}
        self.tag_keys: dict[str, Column] = {}
        self.tag_metrics: dict[str, _Metrics] = {}
        self._tag_frames: dict[str, DataFrame] = {}
        if not suites:
            return
        for i, suite in enumerate(suites):
            self.tag_ids[id(suite)] = i
            for text, key, metric in _keyed_needs(suite):
                k = _norm_key(text)
                self.tag_keys.setdefault(k, key)
                m = self.tag_metrics.setdefault(k, _Metrics())
                m.add("rows", "count(1)")
                if metric:
                    m.add("expr:" + metric, metric)
        tags = ", ".join(f"CASE WHEN coalesce(({_filter_text(x) or 'true'}), false) THEN {i} END"
                         for i, x in enumerate(suites))
        self.tagged_df = self.df.selectExpr("*", f"explode(array({tags})) AS _fid").where("_fid IS NOT NULL")

    def tag_frame(self, k: str) -> DataFrame:
        if k not in self._tag_frames:
            self._tag_frames[k] = _shared(self.tagged_df.groupBy(self.tag_keys[k].alias("col"), "_fid")
                                          .agg(*self.tag_metrics[k].cols.values()))
        return self._tag_frames[k]

    def _add(self, k: str, filt: str | None, mkey: str, sql_text: str) -> str:
        d = self.aliases.setdefault(k, {})
        if (filt, mkey) not in d:
            d[(filt, mkey)] = f"k{len(d)}"
            self.exprs.setdefault(k, []).append(F.expr(f"{sql_text} AS {d[(filt, mkey)]}"))
        return d[(filt, mkey)]

    def frame(self, k: str) -> DataFrame:
        if k not in self._frames:
            self._frames[k] = _shared(self.df.groupBy(self.keys[k].alias("col")).agg(*self.exprs[k]))
        return self._frames[k]

    def view(self, suite: Suite):
        if id(suite) in self.map:
            return _KeyedView(self, self.map[id(suite)])
        if id(suite) in self.tag_ids:
            return _TaggedView(self, self.tag_ids[id(suite)])
        return None


class _KeyedView:
    """One suite's slice of a ``_SharedKeyed`` (same interface as ``_KeyedAggs``)."""

    def __init__(self, shared: _SharedKeyed, mp: dict[str, dict[str, str]]):
        self.shared, self.mp = shared, mp

    def register(self, key_text: str, key: Column, metric: str | None = None) -> tuple[str, str | None]:
        k = _norm_key(key_text)
        return k, (self.mp[k][metric] if metric else None)

    def share(self, k: str, consumers: int) -> DataFrame:
        # keys this filter has no row for do not exist in its own groupBy
        return self.shared.frame(k).where(f"{self.mp[k]['rows']} > 0")


class _TaggedView:
    """One filter's slice of the (key, filter id) grouping."""

    def __init__(self, shared: _SharedKeyed, fid: int):
        self.shared, self.fid = shared, fid

    def register(self, key_text: str, key: Column, metric: str | None = None) -> tuple[str, str | None]:
        k = _norm_key(key_text)
        m = self.shared.tag_metrics[k]
        return k, (m.alias["expr:" + metric] if metric else None)

    def share(self, k: str, consumers: int) -> DataFrame:
        return self.shared.tag_frame(k).where(f"_fid = {self.fid}")


def _filter_text(suite: Suite) -> str | None:
    """The suite's filter with its parameters as literals."""
    f = suite.target.filter
    return None if not f or f.strip() in ("", "1=1") else bind(f, suite.target.args or {})


def _shared_scans(suites: list[Suite]) -> dict[int, _SharedScan]:
    """Group suites whose tables are the same plan (``sameSemantics``: two
    reads of one table qualify) and whose filters differ."""
    groups: list[list[Suite]] = []
    for s in suites:
        for g in groups:
            d = g[0].target.df
            if d is s.target.df or d.sameSemantics(s.target.df):
                g.append(s)
                break
        else:
            groups.append([s])
    out = {}
    for g in groups:
        if len(g) > 1 and len({_filter_text(s) for s in g}) > 1:
            sc = _SharedScan(g)
            for s in g:
                out[id(s)] = sc
    return out


def _scalar_rows(agg: DataFrame, plan, types, ctx: RunContext) -> DataFrame:
    """One row per (scalar rule, column) from the one-row aggregate."""
    structs = []
    for spec, column, m in plan:
        if spec.family in ("trending", "std_dev"):
            c = Q.ident(m)
            structs.append(_row(spec, column, tgt_num=Q.value_num(c, types[m]),
                                tgt_text=Q.value_text(c, types[m])))
        elif spec.family == "compare_to_source":
            t, s = Q.ident(m[0]), Q.ident(m[1])
            structs.append(_row(spec, column, tgt_num=t, tgt_text=t, src_num=s, src_text=s,
                                pre_pass=Q.source_count_pass(t, s, Q.lit(float(spec.threshold.value)))))
        elif spec.family == "empty_null":
            t = Q.ident(m)
            structs.append(_row(spec, column, tgt_num=t, tgt_text=t, src_num="0", src_text="'0'",
                                pre_pass=f"coalesce({t} = 0, false)"))
        elif spec.family == "up_to_date":
            d = Q.ident(m)
            structs.append(_row(spec, column, tgt_text=d, src_text=Q.lit(ctx.as_of.isoformat()),
                                threshold="NULL",
                                pre_pass=f"coalesce({d} >= DATE'{ctx.as_of.isoformat()}', false)"))
    return agg.selectExpr(f"explode(array({', '.join(structs)})) AS r").select("r.*")


def _norm_key(text: str) -> str:
    """Canonical text of a group key, so ``CAST(ts AS DATE)`` and
    ``to_date(ts)`` (and the missing_dates column ``ts``) share one groupBy."""
    t = re.sub(r"\s+", "", text.lower())
    m = re.fullmatch(r"to_date\((.+)\)", t)
    if m:
        t = f"cast({m.group(1)}asdate)"
    return t


class _KeyedAggs:
    """One ``groupBy(key)`` per distinct key expression of a suite.

    All day_to_day metrics on a key and the present dates of a missing_dates
    column with the same day key come from that single aggregation (one scan,
    partial aggregation per task, one shuffle of at most (keys x tasks) rows).
    """

    def __init__(self, target: TableRef):
        self.target = target
        self.keys: dict[str, Column] = {}
        self.metrics: dict[str, _Metrics] = {}
        self._frames: dict[str, DataFrame] = {}

    def register(self, key_text: str, key: Column, metric: str | None = None) -> tuple[str, str | None]:
        k = _norm_key(key_text)
        if k not in self.keys:
            self.keys[k] = key
            self.metrics[k] = _Metrics()
            self.metrics[k].add("rows", "count(1)")
        alias = self.metrics[k].add("expr:" + metric, metric) if metric else None
        return k, alias

    def frame(self, k: str) -> DataFrame:
        if k not in self._frames:
            self._frames[k] = (self.target.filtered().groupBy(self.keys[k].alias("col"))
                               .agg(*self.metrics[k].cols.values()))
        return self._frames[k]

    def share(self, k: str, consumers: int) -> DataFrame:
        f = self.frame(k)
        if consumers > 1:
            self._frames[k] = f = _shared(f)
        return f


def _shared(df: DataFrame, one_row: bool = False) -> DataFrame:
    """A small aggregate that several branches of one plan read: an exchange that Spark reuses.

    Reuse needs the same plan below the exchange in every branch, but each branch would prune its own columns
    and push its own filters down there.  So a row travels as one array of one struct, whose fields are taken
    after an ``explode_outer``: nothing passes through that.  Nothing is cached: two plans share nothing, a plan
    that runs again reads the table again, and lost tasks are recomputed.
    """
    packed = df.select(F.array(F.struct(*(F.col(Q.ident(c)) for c in df.columns))).alias("_rows"))
    packed = packed.repartition(1) if one_row else packed.hint("rebalance")
    return packed.selectExpr("explode_outer(filter(_rows, r -> r IS NOT NULL)) AS _row").selectExpr("_row.*")


def _date_key(suite: Suite, column: str) -> tuple[str, Column]:
    """Day key of a missing_dates column: the column itself when it is already
    a DATE (so a day_to_day rule grouping by it shares the groupBy), else its
    cast to DATE."""
    if isinstance(suite.target.df.selectExpr(column).schema.fields[0].dataType, T.DateType):
        return column, F.expr(column)
    return f"CAST({column} AS DATE)", F.to_date(F.expr(column))


def _day_key(spec: CheckSpec) -> tuple[str, Column]:
    keys = Q.split_top_level(spec.group_by)
    if len(keys) == 1:
        return keys[0], F.expr(keys[0])
    return spec.group_by, concat_key(keys)


def _history_lookups(spark: SparkSession, suites: list[Suite], ctx: RunContext,
                     history: DataFrame | R.StoredResults | None) -> dict | None:
    """Baselines of every suite of a run from ONE pass over the history per
    family, keyed by ``<suite index>|<rule id>`` (several suites may reuse a
    rule id); each suite reads its slice of the shared result."""
    if history is None or len(suites) < 2:
        return None
    trend_rows, band_rows, cmp_dates = [], [], []
    for si, suite in enumerate(suites):
        db, schema, table = suite.target.parts
        for s in suite.specs:
            if not s.enabled:
                continue
            if s.family == "trending":
                d = H.compare_date(ctx.as_of, s.compare_type)
                cmp_dates.append(d)
                trend_rows += [(f"{si}|{s.check_id}", db, schema, table, c, d) for c in s.columns]
            elif s.family == "std_dev":
                band_rows += [(f"{si}|{s.check_id}", db, schema, table, c, None) for c in s.columns]
    out = {}
    if trend_rows:
        out["base"] = _shared(H.trending_baselines(history, trend_rows, ctx, cmp_dates))
    if band_rows:
        out["stats"] = _shared(H.weekly_band_stats(history, band_rows, ctx))
    return out


def _slice(frame: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return (frame.where(F.col("check_id").startswith(prefix))
            .selectExpr(f"substring(check_id, {len(prefix) + 1}) AS check_id", *cols))


def _finish_scalar(rows: DataFrame, suite: Suite, specs: list[CheckSpec], ctx: RunContext,
                   history: DataFrame | R.StoredResults | None, spark: SparkSession,
                   lookups: dict | None = None,
                   prefix: str = "") -> DataFrame:
    db, schema, table = suite.target.parts
    trend = [s for s in specs if s.family == "trending"]
    band = [s for s in specs if s.family == "std_dev"]
    base = None
    if lookups is not None and trend and "base" in lookups:
        base = _slice(lookups["base"], prefix, ["dq_column", "base_num"])
        rows = rows.join(F.broadcast(base), ["check_id", "dq_column"], "left")
    elif history is not None and trend:
        cmp = {s.check_id: H.compare_date(ctx.as_of, s.compare_type) for s in trend}
        wanted = [(s.check_id, db, schema, table, c, cmp[s.check_id]) for s in trend for c in s.columns]
        base = H.trending_baselines(history, wanted, ctx, list(cmp.values()))
        # One row per configured (rule, column) at most: a proven bound, broadcast.
        rows = rows.join(F.broadcast(base), ["check_id", "dq_column"], "left")
    else:
        rows = rows.selectExpr("*", "CAST(NULL AS DOUBLE) AS base_num")
    if lookups is not None and band and "stats" in lookups:
        stats = _slice(lookups["stats"], prefix,
                       ["dq_column", "last_value", "avg_diff", "sd_diff", "num_weeks"])
        rows = rows.join(F.broadcast(stats), ["check_id", "dq_column"], "left")
    elif history is not None and band:
        wanted = [(s.check_id, db, schema, table, c, None) for s in band for c in s.columns]
        stats = H.weekly_band_stats(history, wanted, ctx)
        rows = rows.join(F.broadcast(stats), ["check_id", "dq_column"], "left")
    else:
        rows = rows.selectExpr("*", "CAST(NULL AS DOUBLE) AS last_value", "CAST(NULL AS DOUBLE) AS avg_diff",
                               "CAST(NULL AS DOUBLE) AS sd_diff", "CAST(NULL AS BIGINT) AS num_weeks")

    t_pass = Q.relative_change_pass("tgt_num", "base_num", "mode", "t_value", "t_low")
    bottom, top = Q.band_bounds("last_value", "avg_diff", "sd_diff", "t_value")
    bound_text = (f"CASE WHEN mode = 'upward' THEN {Q.int_text(top)} "
                  f"WHEN mode = 'downward' THEN {Q.int_text(bottom)} "
                  f"ELSE concat({Q.int_text(bottom)}, '|', {Q.int_text(top)}) END")
    stats_text = (f"concat({bound_text}, ' (last_src=', {Q.int_text('last_value')}, ')', "
                  f"' (avg_diff=', {Q.int_text(Q.round_int('avg_diff'))}, ')', "
                  f"' (src_stddev=', {Q.int_text(Q.round_int('sd_diff'))}, ')', "
                  f"' (cnt=', CAST(num_weeks AS STRING), ')')")
    b_text = f"CASE WHEN last_value IS NULL THEN {bound_text} ELSE {stats_text} END"
    b_pass = Q.band_pass("tgt_num", bottom, top, "mode")
    is_pass = (f"coalesce(CASE WHEN family = 'trending' THEN {t_pass} WHEN family = 'std_dev' THEN {b_pass} "
               f"ELSE pre_pass END, false)")
    src_text = (f"CASE WHEN family = 'trending' THEN {Q.num_text('base_num')} "
                f"WHEN family = 'std_dev' THEN {b_text} ELSE src_text END")
    return rows.selectExpr(
        f"{Q.lit(db)} AS database_name", f"{Q.lit(schema)} AS schema_name",
        f"{Q.lit(table)} AS table_name", f"{Q.lit(suite.target.filter_text)} AS table_filter",
        "check_id", "family AS dq_name", "dq_column", "dq_description", "tgt_text AS dq_tgt_value",
        f"{src_text} AS dq_src_value", "dq_threshold", f"{is_pass} AS is_pass", "stop_on_failure",
        "false AS is_dq_custom", "is_trial", "tgt_num AS dq_tgt_num", "dq_column AS rule_column")


def _stamp(df: DataFrame, suite: Suite, spec: CheckSpec, dq_column: str, tgt: str, tgt_type,
           src_text: str, is_pass: str, threshold: str | None = None, rule_column: str | None = None) -> DataFrame:
    """Verdict columns of a non-scalar part (operands are SQL text)."""
    db, schema, table = suite.target.parts
    return df.selectExpr(
        f"{Q.lit(db)} AS database_name", f"{Q.lit(schema)} AS schema_name",
        f"{Q.lit(table)} AS table_name", f"{Q.lit(suite.target.filter_text)} AS table_filter",
        f"{Q.lit(spec.check_id)} AS check_id", f"{Q.lit(spec.dq_name)} AS dq_name",
        f"{dq_column} AS dq_column", f"{Q.lit(spec.description_text())} AS dq_description",
        f"{Q.value_text(tgt, tgt_type)} AS dq_tgt_value", f"CAST({src_text} AS STRING) AS dq_src_value",
        f"CAST({Q.lit(spec.threshold.text) if threshold is None else threshold} AS STRING) AS dq_threshold",
        f"coalesce({is_pass}, false) AS is_pass", f"{Q.lit(spec.stop_on_failure)} AS stop_on_failure",
        "false AS is_dq_custom", f"{Q.lit(spec.is_trial)} AS is_trial",
        f"{Q.value_num(tgt, tgt_type)} AS dq_tgt_num", f"{rule_column or dq_column} AS rule_column")


def unique_rows(suite: Suite, spec: CheckSpec, column: str, shared: "_SharedScan | None" = None) -> DataFrame:
    """C15 for one column (or ``a,b`` composite): distinct vs total count."""
    hit = shared.uniques.get((id(suite), column)) if shared is not None else None
    if hit is not None:
        row, d, t = hit
        stats = row.selectExpr(f"{d} AS distinct_cnt", f"{t} AS total_cnt")
        return _stamp(stats, suite, spec, Q.lit(column), "distinct_cnt", T.LongType(),
                      "total_cnt", "distinct_cnt = total_cnt")
    parts = Q.split_top_level(column)
    keys = [f"_k{i}" for i in range(len(parts))]
    keyed = suite.target.filtered().selectExpr(*[f"{p} AS {k}" for p, k in zip(parts, keys)])
    groups = keyed.groupBy(*keys).agg(F.expr("count(1) AS _n"))
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    stats = groups.selectExpr(f"count_if({complete}) AS distinct_cnt",
                              "coalesce(sum(_n), 0L) AS total_cnt")
    return _stamp(stats, suite, spec, Q.lit(column), "distinct_cnt", T.LongType(),
                  "total_cnt", "distinct_cnt = total_cnt")


def missing_dates_rows(suite: Suite, spec: CheckSpec, column: str, agg: DataFrame, max_alias: str,
                       present: DataFrame) -> DataFrame:
    """C17: dates of the ``window``-day spine ending at the table's max date
    that have no row.  An empty table has a spine of NULL dates: all missing.

    ``agg`` is the fused one-row aggregate holding the max date; ``present``
    is the per-day aggregate of the same day key.
    """
    n = spec.window
    spine = agg.selectExpr(f"explode(transform(sequence(0, {n - 1}), i -> date_sub({max_alias}, i))) AS date_col")
    hits = present.selectExpr("CAST(col AS DATE) AS date_col", "1 AS _hit").where("date_col IS NOT NULL")
    # The spine has exactly ``window`` rows, and so at most have the days that match it (each day is one group
    # of its key): either may be broadcast, on the right side of a left join as Spark can.
    hits = hits.join(F.broadcast(spine), "date_col", "left_semi")
    joined = spine.join(F.broadcast(hits), "date_col", "left")
    stats = joined.selectExpr("sum(CASE WHEN _hit IS NULL THEN 1 ELSE 0 END) AS total_cnt")
    return _stamp(stats, suite, spec, Q.lit(column), "total_cnt", T.LongType(),
                  "'0'", "total_cnt = 0", threshold="NULL")


def day_to_day_rows(suite: Suite, spec: CheckSpec, column: str, grouped: DataFrame, alias: str) -> DataFrame:
    """Aggregate per group key, keep the ``num_days`` highest keys and
    compare each with the next lower present key."""
    top = (grouped.selectExpr("col", f"{alias} AS dq_tgt_value")
           .orderBy(F.col("col").desc_nulls_first()).limit(spec.num_days))
    # At most 30 rows reach this window (validated), so no partition key is needed.
    prev = top.selectExpr("*", "lead(dq_tgt_value) OVER (ORDER BY col DESC NULLS FIRST) AS dq_src_value")
    vtype = grouped.schema[alias].dataType
    thr = spec.threshold
    ok = Q.relative_change_pass("dq_tgt_value", "dq_src_value", Q.lit(thr.mode), Q.lit(float(thr.value)),
                                Q.lit(None if thr.low is None else float(thr.low)))
    label = f"concat({Q.lit(column + ' [')}, CAST(col AS STRING), ']')"
    return _stamp(prev, suite, spec, label, "dq_tgt_value", vtype,
                  Q.value_text("dq_src_value", vtype), ok, rule_column=Q.lit(column))


def custom_rows(spark: SparkSession, suite: Suite, spec: CheckSpec) -> DataFrame:
    """User query returning ``tgt_value, src_value, result`` (0 passes)."""
    q = spec.sql
    if callable(q):
        df = q(spark)
    else:
        text = q
        if isinstance(q, str) and q.strip().endswith(".sql") and "\n" not in q.strip():
            import os
            with open(os.path.expandvars(q.strip())) as fh:
                text = fh.read()
        df = spark.sql(text, args=spec.args or suite.target.args, **(spec.frames or {}))
    types = {f.name: f.dataType for f in df.schema.fields}
    db, schema, table = suite.target.parts
    return df.selectExpr(
        f"{Q.lit(db)} AS database_name", f"{Q.lit(schema)} AS schema_name",
        f"{Q.lit(table)} AS table_name", "CAST(NULL AS STRING) AS table_filter",
        f"{Q.lit(spec.check_id)} AS check_id", f"{Q.lit(spec.check_id)} AS dq_name",
        "'' AS dq_column", f"{Q.lit(spec.description)} AS dq_description",
        f"{Q.value_text('tgt_value', types['tgt_value'])} AS dq_tgt_value",
        f"{Q.value_text('src_value', types['src_value'])} AS dq_src_value",
        "CAST(NULL AS STRING) AS dq_threshold", "coalesce(result = 0, false) AS is_pass",
        f"{Q.lit(spec.stop_on_failure)} AS stop_on_failure", "true AS is_dq_custom",
        f"{Q.lit(spec.is_trial)} AS is_trial",
        f"{Q.value_num('tgt_value', types['tgt_value'])} AS dq_tgt_num", "'' AS rule_column")


def verdict_rows(spark: SparkSession, suite: Suite, ctx: RunContext,
                 history: DataFrame | R.StoredResults | None = None, shared: _SharedScan | None = None,
                 lookups: dict | None = None,
                 prefix: str = "") -> DataFrame:
    """All verdict rows of one suite (not yet stamped with the run)."""
    specs = [s for s in suite.specs if s.enabled]
    parts: list[DataFrame] = []
    scalar = [s for s in specs if s.family in SCALAR_FAMILIES]
    missing = [(s, c) for s in specs if s.family == "missing_dates" for c in s.columns]
    keyed = (shared.keyed.view(suite) if shared is not None and shared.keyed is not None else None) \
        or _KeyedAggs(suite.target)
    d2d = []
    for s in specs:
        if s.family == "day_to_day":
            text, key = _day_key(s)
            for c in s.columns:
                d2d.append((s, c) + keyed.register(text, key, c))
    miss_keys = [keyed.register(*_date_key(suite, c))[0] for _, c in missing]
    uses = {}
    for k in miss_keys + [x[2] for x in d2d]:
        uses[k] = uses.get(k, 0) + 1
    agg = None
    if scalar or missing:
        agg, plan, types, dates = _fused_metrics(suite, scalar, [c for _, c in missing], shared)
        if missing and (plan or len(missing) > 1) and (shared is None or shared.own[id(suite)]):
            agg = _shared(agg, one_row=True)
        if plan:
            rows = _scalar_rows(agg, plan, types, ctx)
            parts.append(_finish_scalar(rows, suite, scalar, ctx, history, spark,
                                        lookups, prefix))
    for (spec, c), k in zip(missing, miss_keys):
        parts.append(missing_dates_rows(suite, spec, c, agg, dates[c], keyed.share(k, uses[k])))
    for spec, c, k, alias in d2d:
        parts.append(day_to_day_rows(suite, spec, c, keyed.share(k, uses[k]), alias))
    for spec in specs:
        if spec.family == "unique":
            parts += [unique_rows(suite, spec, c, shared) for c in spec.columns]
        elif spec.family == "custom":
            parts.append(custom_rows(spark, suite, spec))
    if not parts:
        raise ValueError("suite has no enabled rules")
    # Every part is built with VERDICT_COLUMNS in this order.
    return reduce(lambda a, b: a.unionByName(b), parts)


def _distinct_series(suites: list[Suite]) -> None:
    """A stored series is named by table, segment, family and column.  Warns of suites of one run that write,
    and so later compare, one series twice: a table under several filters that have no segment names."""
    seen: dict[tuple, str | None] = {}
    for suite in suites:
        filt = _filter_text(suite)
        for s in suite.specs:
            if s.enabled and s.family in ("trending", "std_dev"):
                for c in s.columns:
                    if seen.setdefault((suite.target.parts, s.family, c), filt) != filt:
                        warnings.warn(f"{suite.target.name}: {s.family} of {c!r} under several filters is one "
                                      "series in the history; give each TableRef a segment", stacklevel=3)


def run_suite(spark: SparkSession, suites: Suite | list[Suite], ctx: RunContext,
              history: DataFrame | R.StoredResults | None = None) -> DataFrame:
    """Result rows of every enabled rule of every suite, stamped with ``ctx``.

    ``history`` is the result table as it was when the run started (read it
    before appending, so a rule never sees rows of its own run); given as
    ``stored_results``, rules that compare with the last run look for it at once,
    newest run dates first.  The returned
    DataFrame is lazy; write it once with ``append_results``.
    """
    if isinstance(suites, Suite):
        suites = [suites]
    if history is not None:
        _distinct_series(suites)
    shared = _shared_scans(suites)
    lookups = _history_lookups(spark, suites, ctx, history)
    rows = [verdict_rows(spark, s, ctx, history, shared.get(id(s)), lookups, f"{i}|")
            for i, s in enumerate(suites)]
    return to_result(reduce(lambda a, b: a.unionByName(b), rows), ctx)


def expected_rules(spark: SparkSession, suites: Suite | list[Suite], ctx: RunContext) -> DataFrame:
    """One row per enabled (rule, column) of the suites: what a report must
    show even when a rule produced no row (a custom query returning nothing).
    day_to_day rules appear once per column (their rollup)."""
    if isinstance(suites, Suite):
        suites = [suites]
    rows = []
    for suite in suites:
        for s in suite.specs:
            if s.enabled:
                rows += [(ctx.dq_key, *suite.target.parts, s.check_id, s.dq_name, c, s.stop_on_failure) for c in s.columns]
    schema = "dq_key bigint, database_name string, schema_name string, table_name string, check_id string, dq_name string, dq_column string, " \
             "stop_on_failure boolean"
    return spark.createDataFrame(rows, schema)

