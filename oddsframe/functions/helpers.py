"""Null, division and rounding policy as column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never an ANSI division error)."""
    return F.try_divide(c(a), c(b))


def inv(x) -> Column:
    return div(F.lit(1.0), x)


def finite_or(x, default: float = 0.0) -> Column:
    """+-inf and NaN -> default (the ``replace([inf, -inf], 0)`` rule)."""
    x = c(x)
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), F.lit(default)).otherwise(x)


def fill(x, default) -> Column:
    return F.coalesce(c(x), F.lit(default))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; NULL stays NULL."""
    return cond.cast("int")


def round6(x) -> Column:
    """floor(x * 1e6 + 0.5) / 1e6: the same IEEE steps in every engine, so two engines
    holding the same double print the same digits (unlike decimal HALF_UP rounding)."""
    return F.floor(c(x) * 1000000.0 + 0.5) / 1000000.0


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column at the sink (used where transcendental functions or
    double sums make the last bits engine-dependent)."""
    return df.select(*[round6(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])
