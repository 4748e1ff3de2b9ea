"""Exact integer inner products of vectors whose components are whole numbers held as doubles.

A double holds every component exactly, at any size. A sum of products is exact in doubles while
d * max|x| * max|q| stays below 2^53; rows beyond that against the query at hand are multiplied as Python integers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 2.0 ** 53
DIGITS = 10 ** 38 - 1   # a score is exact up to 38 digits and held at this bound beyond


def whole(vec: str, scale: int) -> Column:
    """floor(scale * x) of every component as double; doubles of 2^53 or more have no fraction to drop."""
    def floored(x: Column) -> Column:
        v = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(v) < F.lit(EXACT), F.floor(v).cast("double")).otherwise(v)
    return F.transform(vec, floored)


def taking_part(vectors: DataFrame, vec: str, scale: int) -> DataFrame:
    """Rows whose vector is not null or empty and holds no null or non-finite component."""
    limit = F.lit(1.7976931348623157e308 / scale)  # beyond this a scaled double is no number any more
    return vectors.filter(F.col(vec).isNotNull() & (F.size(vec) > 0)).filter(
        F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= limit)))


def largest(x: np.ndarray) -> np.ndarray:
    """Largest absolute component of every row."""
    return np.abs(x).max(axis=1)


def products(x: np.ndarray, sizes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` (``sizes``: their ``largest``) with ``q``: int64, or Python integers
    where one of them may pass 2^53."""
    if not len(x):
        return np.zeros(0, dtype=np.int64)
    safe = len(q) * sizes * float(np.abs(q).max()) < EXACT
    if safe.all():
        return (x @ q).astype(np.int64)
    out = np.empty(len(x), dtype=object)
    out[safe] = [int(v) for v in x[safe] @ q]
    whole_q = [int(v) for v in q]
    for i in np.flatnonzero(~safe):
        out[i] = sum(int(a) * b for a, b in zip(x[i], whole_q))
    return out


def as_text(score) -> str:
    """A score as decimal text of at most 38 digits."""
    return str(min(max(int(score), -DIGITS), DIGITS))


def as_long(score: Column) -> Column:
    """A decimal score as a 64-bit number; those beyond are held at the bound."""
    edge = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    return F.least(F.greatest(score.cast("decimal(38,0)"), edge(-2 ** 63)), edge(2 ** 63 - 1)).cast("long")
