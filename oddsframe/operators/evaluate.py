"""Evaluation: settlement, accuracy, flat-stake ROI, confusion, macro / pooled league
scores, acceptance gate and ranking. Money is integer cents of a 100 stake, so every
sum is exact and ROI % = P&L / bets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.helpers import div


def settle(df: DataFrame, pred_over: str = "pred_over", label: str = "label_over") -> DataFrame:
    """correct (0/1) and pnl (stake 100: win pays 100 * (odd - 1), loss -100)."""
    correct = (F.col(pred_over) == F.col(label)).cast("int")
    odd = F.when(F.col(pred_over) == 1, F.col("over_odd")).otherwise(F.col("under_odd"))
    win_pay = F.round(odd * 100).cast("int") - 100
    return df.withColumn("correct", correct).withColumn(
        "pnl", F.when(correct == 1, win_pay).otherwise(F.lit(-100)))


def window_score(settled: DataFrame, keys: list[str]) -> DataFrame:
    g = settled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_test"), F.sum("correct").alias("n_correct"),
                                   F.sum("pnl").alias("pnl"))
    return g.select(*keys, "n_test", F.col("n_correct").cast("bigint").alias("n_correct"),
                    div(F.col("n_correct"), F.col("n_test")).alias("accuracy"),
                    F.col("pnl").cast("bigint").alias("pnl"), div(F.col("pnl"), F.col("n_test")).alias("roi_pct"))


def betting_roi(settled: DataFrame, keys: list[str]) -> DataFrame:
    g = settled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bets"), F.sum("correct").alias("n_won"),
                                   F.sum("pnl").alias("pnl"))
    return g.select(*keys, "n_bets", F.col("n_won").cast("bigint").alias("n_won"),
                    F.col("pnl").cast("bigint").alias("pnl"),
                    div(F.col("n_won"), F.col("n_bets")).alias("accuracy"),
                    div(F.col("pnl"), F.col("n_bets")).alias("roi_pct"))


def confusion(settled: DataFrame, keys: list[str], pred_over: str = "pred_over",
              label: str = "label_over") -> DataFrame:
    p, y = F.col(pred_over), F.col(label)
    return settled.groupBy(*keys).agg(
        F.count_if((p == 0) & (y == 0)).alias("tn"), F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 1) & (y == 1)).alias("tp"))


def league_macro(ws: DataFrame, league: str = "event_type_id") -> DataFrame:
    """Mean of per-window accuracy and ROI; windows meeting the accuracy target."""
    g = ws.groupBy(league).agg(
        F.count(F.lit(1)).alias("n_windows"), F.avg("accuracy").alias("macro_accuracy"),
        F.avg("roi_pct").alias("macro_roi_pct"),
        F.count_if(F.col("accuracy") >= config.WINDOW_TARGET_ACCURACY).alias("windows_meeting_target"))
    return g.withColumn("share_meeting_target", div(F.col("windows_meeting_target"), F.col("n_windows")))


def league_pooled(ws: DataFrame, league: str = "event_type_id") -> DataFrame:
    """Sum(correct) / sum(n) and test-size-weighted ROI."""
    g = ws.groupBy(league).agg(F.sum("n_test").alias("n_test"), F.sum("n_correct").alias("n_correct"),
                               F.sum("pnl").alias("pnl"))
    return g.select(league, F.col("n_test").cast("bigint").alias("n_test"),
                    F.col("n_correct").cast("bigint").alias("n_correct"),
                    div(F.col("n_correct"), F.col("n_test")).alias("pooled_accuracy"),
                    div(F.col("pnl"), F.col("n_test")).alias("pooled_roi_pct"))


def acceptance(pooled: DataFrame, completed: DataFrame, league: str = "event_type_id") -> DataFrame:
    """accepted iff accuracy >= 70 %, ROI >= 0 and >= 100 completed matches."""
    j = pooled.join(completed, league, "left")
    acc_ok = F.col("pooled_accuracy") >= config.ACCEPT_MIN_ACCURACY
    roi_ok = F.col("pooled_roi_pct") >= config.ACCEPT_MIN_ROI
    n_ok = F.coalesce(F.col("n_completed"), F.lit(0)) >= config.ACCEPT_MIN_MATCHES
    reason = (F.when(~n_ok, F.lit("too few matches")).when(~acc_ok, F.lit("accuracy below target"))
               .when(~roi_ok, F.lit("negative roi")))
    return j.select(league, "n_test", F.coalesce(F.col("n_completed"), F.lit(0)).cast("bigint").alias("n_completed"),
                    "pooled_accuracy", "pooled_roi_pct",
                    F.when(acc_ok & roi_ok & n_ok, F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
                    reason.alias("reason"))


def ranking(pooled: DataFrame, names: DataFrame, league: str = "event_type_id") -> DataFrame:
    """Leagues ranked by pooled accuracy (one row per league: a global window is fine)."""
    w = Window.orderBy(F.col("pooled_accuracy").desc())
    return (pooled.join(names, league, "left")
                  .select(league, "league_name", "pooled_accuracy", "pooled_roi_pct",
                          F.rank().over(w).cast("int").alias("rank")))
