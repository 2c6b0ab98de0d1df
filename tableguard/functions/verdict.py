"""Verdict expressions, written once as Column functions.

Every function here returns a JVM-side ``Column``; nothing is evaluated in
Python.  Divisions are guarded by earlier ``when`` branches, so ANSI mode never
sees a zero denominator.  The denominator is the *signed* source value, as the
checks have always computed it (a negative source makes absolute mode pass for
any non-negative limit).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def round_int(x) -> Column:
    """Round half away from zero (the ``::INT`` of the checks), in double: a value beyond a BIGINT is
    judged like any other."""
    return F.round(_c(x).cast("double"))


def _finite(x: Column) -> Column:
    return F.abs(x) < F.lit(float("inf"))


def ratio(tgt, src) -> Column:
    """(tgt - src) / src in double; callers guard src = 0."""
    t, s = _c(tgt).cast("double"), _c(src).cast("double")
    return F.try_divide(t - s, s)


def mode_predicate(tgt, src, mode, value, low) -> Column:
    """Predicate of the threshold mode on the relative change."""
    t, s = _c(tgt).cast("double"), _c(src).cast("double")
    r = F.try_divide(t - s, s)
    # abs() of the difference only: the denominator keeps its sign.
    ar = F.try_divide(F.abs(t - s), s)
    mode, value, low = _c(mode), _c(value).cast("double"), _c(low).cast("double")
    return (
        F.when(mode == "range", ar.between(low, value))
        .when(mode == "upward", r.between(F.lit(0.0), value))
        .when(mode == "downward", r.between(value, F.lit(0.0)))
        .otherwise(ar <= value)
    )


def relative_change_pass(tgt, src, mode, value, low=None) -> Column:
    """Verdict R: a missing baseline passes, zero on either side fails."""
    tgt, src = _c(tgt), _c(src)
    return (
        F.when(src.isNull(), F.lit(True))
        .when(src == 0, F.lit(False))
        .when(tgt == 0, F.lit(False))
        .when(mode_predicate(tgt, src, mode, value, low), F.lit(True))
        .otherwise(F.lit(False))
    )


def source_count_pass(tgt, src, value) -> Column:
    """compare_to_source: a missing or empty source fails."""
    tgt, src = _c(tgt), _c(src)
    return (
        F.when(src.isNull(), F.lit(False))
        .when(src == 0, F.lit(False))
        .when(tgt == 0, F.lit(False))
        .when(F.try_divide(F.abs(tgt.cast("double") - src.cast("double")), src.cast("double"))
              <= _c(value).cast("double"), F.lit(True))
        .otherwise(F.lit(False))
    )


def band_bounds(last, avg_diff, sd_diff, t) -> tuple[Column, Column]:
    """Weekly band around the last value: last ± round(avg) ± round(t·sd).

    ``t`` is signed as given; a negative ``t`` flips the spread term (the
    downward behaviour the checks have always had).
    """
    spread = round_int(_c(t).cast("double") * _c(sd_diff))
    mean = round_int(avg_diff)
    last = _c(last).cast("double")
    return last - mean - spread, last + mean + spread


def band_pass(tgt, bottom, top, mode) -> Column:
    """std_dev verdict: absolute inside [bottom, top]; upward strictly below top;
    downward strictly above bottom.  A missing reported bound passes; one that is not
    finite (infinite or NaN values, a spread beyond a double) never does."""
    mode = _c(mode)
    missing = (
        F.when(mode == "upward", top.isNull())
        .when(mode == "downward", bottom.isNull())
        .otherwise(bottom.isNull() | top.isNull())
    )
    tgt_int = round_int(tgt)
    pred = (
        F.when(mode == "upward", (tgt_int < top) & _finite(tgt_int) & _finite(top))
        .when(mode == "downward", (tgt_int > bottom) & _finite(tgt_int) & _finite(bottom))
        .otherwise(_c(tgt).cast("double").between(bottom, top) & _finite(bottom) & _finite(top))
    )
    return F.when(missing, F.lit(True)).when(pred, F.lit(True)).otherwise(F.lit(False))
