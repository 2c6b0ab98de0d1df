"""Text rendering of metric values for the string result columns.

Values are kept numeric in ``dq_tgt_num``; the text columns are for people.
Integral values (counts, rounded bounds) render as plain integers; other
doubles keep Spark's rendering.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, FloatType, NumericType,
                               StringType)


def num_text(x: Column) -> Column:
    """Render a double: integral values without a fraction, others as Spark casts them."""
    d = x.cast("double")
    integral = (d == F.floor(d)) & (F.abs(d) < F.lit(1e15))
    return F.when(d.isNull(), F.lit(None).cast("string")) \
        .when(integral, d.cast("bigint").cast("string")) \
        .otherwise(d.cast("string"))


def value_text(x: Column, dtype) -> Column:
    """Text for a value of a known Spark type."""
    if isinstance(dtype, DecimalType):
        return x.cast("string")  # exact, as written by the type
    if isinstance(dtype, (DoubleType, FloatType)):
        return num_text(x)
    if isinstance(dtype, BooleanType):
        return F.when(x, F.lit("true")).when(~x, F.lit("false"))
    return x.cast("string")


def value_num(x: Column, dtype) -> Column:
    """Numeric twin (double) of a value; NULL when it is not numeric."""
    if isinstance(dtype, NumericType):
        return x.cast("double")
    if isinstance(dtype, StringType):
        return x.try_cast("double")
    return F.lit(None).cast("double")


def concat_key(exprs: list[str]) -> Column:
    """Composite group key as text ``a,b`` (NULL if any part is NULL)."""
    parts = []
    for i, e in enumerate(exprs):
        if i:
            parts.append(F.lit(","))
        parts.append(F.expr(e).cast("string"))
    return F.concat(*parts)
