"""SQL-text twins of the Column helpers, for the plan compiler.

A projection written as one SQL string is parsed once on the JVM side; the
same projection built from ``Column`` objects costs a Py4J round trip per
literal, cast, alias and ``when`` (and another when each proxy is freed).  The
compiler builds one row struct per rule and column, so it uses these.  The
semantics are those of ``verdict.py`` / ``text.py``; a test checks that both
forms agree on the verdict table.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DataType, DecimalType, DoubleType, FloatType,
                               NumericType, StringType)


def lit(v) -> str:
    """A Python value as a Spark SQL literal (doubles as DOUBLE, not DECIMAL)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def num_text(x: str) -> str:
    d = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN {d} IS NULL THEN NULL "
            f"WHEN {d} = floor({d}) AND abs({d}) < 1e15D THEN CAST(CAST({d} AS BIGINT) AS STRING) "
            f"ELSE CAST({d} AS STRING) END")


def value_text(x: str, dtype: DataType) -> str:
    if isinstance(dtype, DecimalType):
        return f"CAST({x} AS STRING)"  # exact, as written by the type
    if isinstance(dtype, (DoubleType, FloatType)):
        return num_text(x)
    if isinstance(dtype, BooleanType):
        return f"CASE WHEN {x} THEN 'true' WHEN NOT {x} THEN 'false' END"
    return f"CAST({x} AS STRING)"


def value_num(x: str, dtype: DataType) -> str:
    if isinstance(dtype, NumericType):
        return f"CAST({x} AS DOUBLE)"
    if isinstance(dtype, StringType):
        return f"try_cast({x} AS DOUBLE)"
    return "CAST(NULL AS DOUBLE)"


def relative_change_pass(tgt: str, src: str, mode: str, value: str, low: str) -> str:
    """Verdict R over SQL operands (mode/value/low may be columns or literals)."""
    t, s = f"CAST({tgt} AS DOUBLE)", f"CAST({src} AS DOUBLE)"
    r = f"try_divide({t} - {s}, {s})"
    ar = f"try_divide(abs({t} - {s}), {s})"
    v, lo = f"CAST({value} AS DOUBLE)", f"CAST({low} AS DOUBLE)"
    pred = (f"CASE WHEN {mode} = 'range' THEN {ar} BETWEEN {lo} AND {v} "
            f"WHEN {mode} = 'upward' THEN {r} BETWEEN 0D AND {v} "
            f"WHEN {mode} = 'downward' THEN {r} BETWEEN {v} AND 0D "
            f"ELSE {ar} <= {v} END")
    # no baseline passes; a zero on either side fails; else the mode's bound
    return f"CASE WHEN {s} IS NULL THEN true WHEN {s} = 0 OR {t} = 0 THEN false ELSE coalesce({pred}, false) END"


def source_count_pass(tgt: str, src: str, value: str) -> str:
    t, s = f"CAST({tgt} AS DOUBLE)", f"CAST({src} AS DOUBLE)"
    # a missing or empty source fails, as does an empty target
    return (f"CASE WHEN {s} IS NULL OR {s} = 0 OR {t} = 0 THEN false "
            f"ELSE coalesce(try_divide(abs({t} - {s}), {s}) <= CAST({value} AS DOUBLE), false) END")


def round_int(x: str) -> str:
    # in double: a value beyond a BIGINT neither stops the suite nor goes unjudged
    return f"round(CAST({x} AS DOUBLE))"


def int_text(x: str) -> str:
    """A rounded double as an integer's text."""
    return (f"coalesce(CAST(TRY_CAST({x} AS BIGINT) AS STRING), CAST(TRY_CAST({x} AS DECIMAL(38, 0)) AS STRING), "
            f"CAST({x} AS STRING))")


def _finite(x: str) -> str:
    return f"abs({x}) < CAST('Infinity' AS DOUBLE)"


def band_bounds(last: str, avg_diff: str, sd_diff: str, t: str) -> tuple[str, str]:
    """(bottom, top) = last -/+ round(avg) -/+ round(t * sd), t signed."""
    spread = round_int(f"CAST({t} AS DOUBLE) * {sd_diff}")
    mean = round_int(avg_diff)
    last = f"CAST({last} AS DOUBLE)"
    return f"({last} - {mean} - {spread})", f"({last} + {mean} + {spread})"


def band_pass(tgt: str, bottom: str, top: str, mode: str) -> str:
    missing = (f"CASE WHEN {mode} = 'upward' THEN {top} IS NULL WHEN {mode} = 'downward' THEN {bottom} IS NULL "
               f"ELSE {bottom} IS NULL OR {top} IS NULL END")
    t = round_int(tgt)
    pred = (f"CASE WHEN {mode} = 'upward' THEN {t} < {top} AND {_finite(t)} AND {_finite(top)} "
            f"WHEN {mode} = 'downward' THEN {t} > {bottom} AND {_finite(t)} AND {_finite(bottom)} "
            f"ELSE CAST({tgt} AS DOUBLE) BETWEEN {bottom} AND {top} AND {_finite(bottom)} AND {_finite(top)} END")
    return f"CASE WHEN {missing} THEN true WHEN {pred} THEN true ELSE false END"


def split_top_level(text: str) -> list[str]:
    """Split ``a, f(b, c), 'x,y'`` at commas outside parentheses and quotes."""
    parts, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    parts.append("".join(cur).strip())
    return [p for p in parts if p]
