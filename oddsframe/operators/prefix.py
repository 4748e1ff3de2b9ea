"""Distributed running totals keyed by (keys, time) without one-task-per-key windows.

A window ``PARTITION BY team ORDER BY time`` sends every row of a team to one task;
with few teams (or one team holding a third of the data) that task is the job. Here:

1. partial aggregation to one row per distinct (keys, time)  (map-side combine);
2. bucket totals per (keys, month) and a window over buckets: the window partition
   is one row per month of a key, however many rows the key has;
3. a window over the distinct times inside each (keys, month) for the in-bucket offset.

``time_prefix`` gives, for every distinct (keys, time), totals over *strictly
earlier* times. ``positions`` adds 1-based row positions under (time, tie-break)
order plus inclusive running totals; its only row-level window is over rows sharing
one (keys, time), which is bounded by the rows of one key at one instant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(col: Column, bucket: str | int | Column) -> Column:
    """Coarse bucket of the order column: a date_trunc unit for timestamps, an integer
    width for integral order columns (ids), or a column that never falls as the order column rises."""
    if isinstance(bucket, Column):
        return bucket
    if isinstance(bucket, int):
        return F.floor(col / bucket)
    return F.date_trunc(bucket, col)


def time_prefix(df: DataFrame, keys: list[str], time_col: str, values: dict[str, Column],
                bucket: str | int | Column = "month", keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Returns keys, time, ``<v>_before`` (sum over strictly earlier times) and ``<v>_at``
    (sum at exactly this time) for every distinct (keys, time) of ``df``. NULL values
    count as 0, so rows carried only to make their time present contribute nothing.
    ``time_col`` may be any orderable column; ``bucket`` is as in ``_bucket``. ``keep`` (writes and reads back) is applied to the
    totals per time and to the result, which are otherwise computed anew, from the rows, by each of their readers."""
    names = list(values)
    per_t = (df.groupBy(*keys, time_col)
               .agg(*[F.sum(F.coalesce(v, F.lit(0))).alias(n) for n, v in values.items()])
               .withColumn("_bk", _bucket(F.col(time_col), bucket)))
    if keep is not None:
        per_t = keep(per_t)
    per_b = per_t.groupBy(*keys, "_bk").agg(*[F.sum(n).alias(n) for n in names])
    wb = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    off = per_b.select(*keys, "_bk", *[F.coalesce(F.sum(n).over(wb), F.lit(0)).alias(f"_off_{n}")
                                        for n in names])
    wt = Window.partitionBy(*keys, "_bk").orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    inb = per_t.select(*keys, time_col, "_bk",
                       *[F.coalesce(F.sum(n).over(wt), F.lit(0)).alias(f"_in_{n}") for n in names],
                       *[F.col(n).alias(f"{n}_at") for n in names])
    out = inb.join(off, [*keys, "_bk"], "inner")
    out = out.select(*keys, time_col,
                     *[(F.col(f"_off_{n}") + F.col(f"_in_{n}")).alias(f"{n}_before") for n in names],
                     *[f"{n}_at" for n in names])
    return out if keep is None else keep(out)


def positions(df: DataFrame, keys: list[str], time_col: str, tiebreak: list[str],
              values: dict[str, Column], carry: list[str] | tuple[str, ...] = (),
              bucket: str = "month", split_instant: int | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Row position ``pos`` (1-based, order time then tiebreak within keys), the row's
    own values and inclusive running totals ``<v>_cum``; ``carry`` columns pass through.

    Rows sharing one (keys, time) are ranked by a window over that instant; they arrive
    hash-partitioned on (keys, time) from the join with the prefix table, so the window
    adds no shuffle. When an instant can hold an unbounded number of rows (all matches
    of a league on one day), ``split_instant`` = id-bucket width ranks inside
    (instant, floor(id / width)) and adds per-bucket offsets from a partial count and a
    window over the bucket counts: no window partition holds more than one bucket. ``keep`` is as in ``time_prefix``."""
    vals = {n: F.coalesce(v, F.lit(0)) for n, v in values.items()}
    base = df.select(*keys, time_col, *tiebreak, *carry, *[v.alias(f"_v_{n}") for n, v in vals.items()])
    pre = time_prefix(base, keys, time_col,
                      {"_n": F.lit(1), **{n: F.col(f"_v_{n}") for n in vals}}, bucket, keep)
    j = base.join(pre.select(*keys, time_col, "_n_before", *[f"{n}_before" for n in vals]),
                  [*keys, time_col], "inner")
    if split_instant is None:
        w = Window.partitionBy(*keys, time_col).orderBy(*tiebreak)
        wc = w.rowsBetween(Window.unboundedPreceding, 0)
        ranked = j.select("*", F.row_number().over(w).alias("_rk"),
                          *[F.sum(f"_v_{n}").over(wc).alias(f"_c_{n}") for n in vals])
    else:
        if len(tiebreak) != 1:
            raise ValueError("split_instant needs one unique integral tiebreak column")
        inst = [*keys, time_col]
        jb = j.withColumn("_ib", F.floor(F.col(tiebreak[0]) / split_instant))
        cnt = jb.groupBy(*inst, "_ib").agg(F.count(F.lit(1)).alias("_bn"),
                                           *[F.sum(f"_v_{n}").alias(f"_bs_{n}") for n in vals])
        wo = Window.partitionBy(*inst).orderBy("_ib").rowsBetween(Window.unboundedPreceding, -1)
        off = cnt.select(*inst, "_ib", F.coalesce(F.sum("_bn").over(wo), F.lit(0)).alias("_ib_off"),
                         *[F.coalesce(F.sum(f"_bs_{n}").over(wo), F.lit(0)).alias(f"_ibo_{n}") for n in vals])
        wi = Window.partitionBy(*inst, "_ib").orderBy(tiebreak[0])
        wic = wi.rowsBetween(Window.unboundedPreceding, 0)
        r0 = jb.select("*", F.row_number().over(wi).alias("_rk0"),
                       *[F.sum(f"_v_{n}").over(wic).alias(f"_c0_{n}") for n in vals])
        ranked = r0.join(off, [*inst, "_ib"], "inner").select(
            *j.columns, (F.col("_ib_off") + F.col("_rk0")).alias("_rk"),
            *[(F.col(f"_ibo_{n}") + F.col(f"_c0_{n}")).alias(f"_c_{n}") for n in vals])
    return ranked.select(*keys, time_col, *tiebreak, *carry,
                         (F.col("_n_before") + F.col("_rk")).alias("pos"),
                         *[F.col(f"_v_{n}").alias(n) for n in vals],
                         *[(F.col(f"{n}_before") + F.col(f"_c_{n}")).alias(f"{n}_cum") for n in vals])
