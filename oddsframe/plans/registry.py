"""Query registry: name -> (Spark builder, DuckDB oracle text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from oddsframe.functions.helpers import round_doubles
from oddsframe.plans.oracle_base import sql

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, body: str | None = None, ctes: tuple[tuple[str, str], ...] = (),
             rounded: bool = False):
    """Register a query; ``body`` is the oracle SELECT (None = rows-only check).

    ``rounded``: doubles leave the Spark side through ``round6``; the oracle text must
    apply ``rr6`` to the same columns."""
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounded else df
        run.__name__ = fn.__name__
        run.__module__ = fn.__module__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if body is not None:
            ORACLES[name] = sql(body, *ctes)
        return run
    return deco
