"""Latest / as-of quote resolution over append-only odds histories.

Ordering for "latest" is deterministic: created_at DESC, quote_id DESC, then every
payload column DESC (NULLs last), so every engine picks the same row on ties.

Scale notes
* ``method="agg"``: ``max(struct(order..., payload...))`` per key. Partial
  aggregation runs before the shuffle, so each map task sends at most one row per
  key; a key holding a third of all quotes costs no more than any other.
* ``method="window"``: ``row_number() = 1``; Spark plans a partial
  WindowGroupLimit before the exchange, with the same one-row-per-key-per-task bound.
* ``method="max_by"`` (default): ``max_by(payload, order)``, the same bound as ``agg``
  and the fastest form measured. Spark plans a sort aggregation for it, so each task sorts
  its own quotes; tables written by ``save_bucketed`` arrive sorted by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsframe.sources.tables import QUOTE_PAYLOAD, Tables


def latest_per_key(quotes: DataFrame, payload: list[str], key: str = "event_id",
                   order: tuple[str, ...] = ("created_at", "quote_id"),
                   method: str = "max_by") -> DataFrame:
    ordering = list(order) + list(payload)
    cols = [key] + ordering
    q = quotes.select(*cols)
    if method == "window":
        w = Window.partitionBy(key).orderBy(*[F.col(x).desc_nulls_last() for x in ordering])
        return q.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if method == "max_by":
        best = F.max_by(F.struct(*ordering), F.struct(*ordering)).alias("_best")
        return q.groupBy(key).agg(best).select(key, *[F.col(f"_best.{x}").alias(x) for x in ordering])
    best = F.max(F.struct(*ordering)).alias("_best")
    return q.groupBy(key).agg(best).select(key, *[F.col(f"_best.{x}").alias(x) for x in ordering])


def latest_with_ties(quotes: DataFrame, payload: list[str], key: str = "event_id",
                     ts: str = "created_at") -> DataFrame:
    """Every quote at the per-key maximum timestamp (the MAX self-join form).

    The maximum is a partial aggregation; the join back is on (key, ts), so a hot
    key is spread over its distinct timestamps and AQE can split what is left."""
    mx = quotes.groupBy(key).agg(F.max(ts).alias(ts))
    return quotes.select(key, ts, "quote_id", *payload).join(mx, [key, ts], "inner")


def asof_latest(quotes: DataFrame, events: DataFrame, payload: list[str],
                key: str = "event_id", ts: str = "created_at", bound: str = "start_time",
                method: str = "max_by") -> DataFrame:
    """Latest quote strictly before the event's kick-off (leak-free).

    Equi-join on the key with a range predicate, then latest-per-key. The event side
    is one narrow row per key; AQE broadcasts it only when its measured size is below
    the threshold and splits a skewed quote partition otherwise."""
    bounded = (quotes.join(events.select(key, bound), key, "inner")
                     .filter(F.col(ts) < F.col(bound)).drop(bound))
    return latest_per_key(bounded, payload, key=key, method=method)


def latest_quotes(t: Tables, method: str = "max_by") -> dict[str, DataFrame]:
    return {name: latest_per_key(getattr(t, name), QUOTE_PAYLOAD[name], method=method)
            for name in ("ou", "win", "hcp")}


def quote_coverage(t: Tables) -> DataFrame:
    """Quote rows vs distinct matches per quote table (rows != matches)."""
    def one(name, df):
        return df.agg(F.count(F.lit(1)).alias("n_quotes"),
                      F.countDistinct("event_id").alias("n_events")).select(
            F.lit(name).alias("quote_table"), "n_quotes", "n_events")
    return (one("fb_over_under_odd", t.ou).unionByName(one("fb_win_odd", t.win))
            .unionByName(one("fb_handicap_odd", t.hcp)))
