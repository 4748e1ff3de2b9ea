"""Training-side operators: labels, gates, chronological split, standardisation,
fold assignment, ANOVA feature scores, threshold search and grouped logistic fits.

Every per-window computation runs for all (league, season, window) groups in one job.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions import market
from oddsframe.functions.calendar import with_season_window
from oddsframe.functions.helpers import div
from oddsframe.operators import history as H
from oddsframe.operators import matches as M
from oddsframe.operators.prefix import positions
from oddsframe.session import checkpoint_dir, stored
from oddsframe.sources.tables import Tables

WKEYS = ["event_type_id", "season_start", "window_no"]
# width of event_id buckets when ranking the matches of one (window, kick-off instant):
# a league's kick-off instant may hold any number of matches, so it is split
INSTANT_BUCKET = 1 << 16

# model features (market + leak-free history), in assembly order
MARKET_FEATURES = ["p_over_fair", "ou_overround", "cap_minus_25", "ou_odds_ratio"]
HISTORY_FEATURES = ["exp_total_half", "avg_over_rate"]
FEATURES = MARKET_FEATURES + HISTORY_FEATURES
FEATURE_SETS = {
    "odds_only": ["p_over_fair", "ou_overround"],
    "odds_plus_market": MARKET_FEATURES,
    "full": FEATURES,
}
FORBIDDEN = ("home_ft_score", "away_ft_score", "home_ht_score", "away_ht_score", "total_goals", "label_over")


def assert_no_leakage(features: list[str]) -> None:
    """Leakage guard: no result column may be assembled as a feature."""
    bad = [f for f in features if f in FORBIDDEN]
    if bad:
        raise ValueError(f"result columns used as features: {bad}")


def label_over() -> Column:
    """OVER iff total goals > cap; total == cap counts as UNDER (no push)."""
    return ((F.col("home_ft_score") + F.col("away_ft_score")) > F.col("over_under_cap")).cast("int")


def market_columns() -> list[Column]:
    return [market.p_over_fair().alias("p_over_fair"),
            (market.p_over() + market.p_under()).alias("ou_overround"),
            (F.col("over_under_cap") - 2.5).alias("cap_minus_25"),
            div("over_odd", "under_odd").alias("ou_odds_ratio")]


def history_columns(spark: SparkSession, mf: DataFrame) -> DataFrame:
    """event_id + history features with league cold-start defaults."""
    tl = M.team_long(mf)
    tab = H.expanding_table(tl, H.LEAGUE_TEAM)
    base = mf.select("event_id", "event_type_id", "start_time", "home_id", "away_id", "over_under_cap")
    cs = H.with_cold_start(H.two_sided(base, tab, carry=["event_type_id"]).select(
        "event_id", "event_type_id", *H.rates("home"), *H.rates("away")), spark)
    hs, hc, as_, ac = (F.col(c) for c in ("home_scored", "home_conceded", "away_scored", "away_conceded"))
    return cs.select("event_id", ((hs + as_ + hc + ac) / 2).alias("exp_total_half"),
                     ((F.col("home_over_rate") + F.col("away_over_rate")) / 2).alias("avg_over_rate"))


def train_frame(spark: SparkSession, t: Tables, with_history: bool = False, matches: DataFrame | None = None) -> DataFrame:
    """Played matches with an O/U quote from before the kick-off and a season window: label +
    features. Later quotes are never seen, nor are they in the caps of the history.
    ``matches``: a written frame with such quotes, if there is one."""
    # written once: positions and folds read the matches many times over
    mf = stored(M.match_asof(t), "asof-matches") if matches is None else matches
    base = (mf.filter(M.is_played() & F.col("over_odd").isNotNull())
              .select("event_id", "event_type_id", "start_time", "home_ft_score", "away_ft_score",
                      "over_odd", "under_odd", "over_under_cap", *market_columns(),
                      (F.col("home_ft_score") + F.col("away_ft_score")).cast("int").alias("total_goals"),
                      label_over().alias("label_over")))
    out = with_season_window(base, spark).filter(F.col("window_no").isNotNull())
    if with_history:
        out = out.join(history_columns(spark, mf), "event_id", "inner")
    return out


def window_sizes(tf: DataFrame) -> DataFrame:
    return tf.groupBy(*WKEYS).agg(F.count(F.lit(1)).alias("n_window"))


def chrono_split(tf: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Position by (start_time, event_id) inside each window; train = pos*10 <= n*7
    (floor(0.7 n) rows, integer arithmetic so no float edge at n = 90, 170, 180).

    The window sizes table has one row per (league, season, window): at most 4 per
    league and year, so it is broadcast. ``keep`` is as in ``prefix.time_prefix``."""
    pos = positions(tf, WKEYS, "start_time", ["event_id"], {"_one": F.lit(1)},
                    carry=[c for c in tf.columns if c not in WKEYS + ["start_time", "event_id"]],
                    split_instant=INSTANT_BUCKET, keep=keep)
    out = pos.drop("_one", "_one_cum").join(F.broadcast(window_sizes(tf)), WKEYS, "inner")
    return out.withColumn("is_train", (F.col("pos") * config.TRAIN_DEN
                                       <= F.col("n_window") * config.TRAIN_NUM).cast("int"))


def window_min(league: str = "event_type_id") -> Column:
    """Least matches of a window that is trained on, by league."""
    out = F.lit(config.WINDOW_MIN_MATCHES)
    for lg, n in sorted(config.LEAGUE_WINDOW_MIN.items()):
        out = F.when(F.col(league) == lg, F.lit(n)).otherwise(out)
    return out


def gated(split: DataFrame, min_n: int | Column | None = None) -> DataFrame:
    """Rows of windows with at least ``min_n`` matches (the league's own minimum unless given)."""
    return split.filter(F.col("n_window") >= (window_min() if min_n is None else min_n))


def league_sizes(t: Tables, matches: DataFrame | None = None) -> DataFrame:
    """``(event_type_id, n_league)``: completed matches of a league with an O/U quote from before the kick-off (``matches``: a
    written frame with such quotes, if there is one)."""
    return ((M.match_asof(t) if matches is None else matches).filter(M.is_played() & F.col("over_odd").isNotNull())
            .groupBy("event_type_id").agg(F.count(F.lit(1)).alias("n_league")))


def training_status(tf: DataFrame, leagues: DataFrame) -> DataFrame:
    """One row per season window: its size, its league's, and whether it is trained on (``trained``, ``window too small`` or
    ``league too small``). Nothing that a gate stops goes missing."""
    n, n_league = F.col("n_window"), F.coalesce("n_league", F.lit(0).cast("long"))
    status = (F.when(n_league < config.LEAGUE_MIN_MATCHES, F.lit("league too small")).when(n < window_min(), F.lit("window too small"))
              .otherwise(F.lit("trained")))
    windows = tf.groupBy(*WKEYS, "window_label").agg(F.count(F.lit(1)).alias("n_window"))
    return windows.join(leagues, "event_type_id", "left").select(
        *WKEYS, "window_label", "n_window", n_league.alias("n_league"), window_min().cast("int").alias("min_window"), status.alias("status"))


def standardize_stats(train: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Per group and feature: mean and population std (the scaler of the predictors)."""
    wide = stats_wide(train, keys, features)
    stack = ", ".join(f"'{f}', `{f}__mean`, `{f}__std`" for f in features)
    return wide.selectExpr(*keys, "n_train", f"stack({len(features)}, {stack}) AS (feature, mean, std)")


def standardized(df: DataFrame, stats_wide: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """z = (x - mean) / std with the group's train stats (std 0 -> z 0)."""
    j = df.join(F.broadcast(stats_wide), keys, "inner")
    return j.select(*df.columns, *[F.coalesce(div(F.col(f) - F.col(f"{f}__mean"), F.col(f"{f}__std")),
                                              F.lit(0.0)).alias(f"z_{f}") for f in features])


def stats_wide(train: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}__mean"), F.stddev_pop(f).alias(f"{f}__std")]
    return train.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_train"), *aggs)


def cv_folds(split: DataFrame, k: int = 5) -> DataFrame:
    """Stratified fold: position within (window, label) by (start_time, event_id), mod k."""
    keys = WKEYS + ["label_over"]
    rows = stored(split.select(*keys, "start_time", "event_id"), "fold-rows")
    pos = positions(rows, keys, "start_time", ["event_id"], {"_one": F.lit(1)}, split_instant=INSTANT_BUCKET)
    return pos.select(*keys, "event_id", ((F.col("pos") - 1) % k).cast("int").alias("fold"))


def anova_f(train: DataFrame, keys: list[str], features: list[str], label: str = "label_over") -> DataFrame:
    """One-way ANOVA F per group and feature from per-class count / sum / sum of squares
    (partial aggregation; no group is collected)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        aggs += [F.sum(f).alias(f"{f}__s"), F.sum(F.col(f) * F.col(f)).alias(f"{f}__q")]
    per_class = train.groupBy(*keys, label).agg(*aggs)
    stack = ", ".join(f"'{f}', `{f}__s`, `{f}__q`" for f in features)
    long = per_class.selectExpr(*keys, label, "n", f"stack({len(features)}, {stack}) AS (feature, s, q)")
    g = long.groupBy(*keys, "feature").agg(
        F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("q").alias("Q"),
        F.count(F.lit(1)).alias("C"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("SS_cls"))
    ss_between = F.col("SS_cls") - F.col("S") * F.col("S") / F.col("N")
    ss_within = F.col("Q") - F.col("SS_cls")
    # one class, or no more rows than classes: no F value
    f_stat = div(div(ss_between, F.col("C") - 1), div(ss_within, F.col("N") - F.col("C")))
    return g.select(*keys, "feature", F.col("N").alias("n_train"), f_stat.alias("f_score"))


def threshold_search(train: DataFrame, keys: list[str], score: str = "p_over_fair",
                     label: str = "label_over") -> DataFrame:
    """The best threshold of the default grid per group (see ``threshold_search_grids``)."""
    grid = (config.THRESHOLD_GRID_LO, config.THRESHOLD_GRID_HI, 1, config.THRESHOLD_GRID_DEN)
    return threshold_search_grids(train, keys, {"default": grid}, score, label).drop("grid")


def threshold_search_grids(train: DataFrame, keys: list[str], grids: dict[str, tuple[int, int, int, int]],
                           score: str = "p_over_fair", label: str = "label_over") -> DataFrame:
    """Per group and grid, the threshold t_k = (lo + k * step) / den that maximises the train
    accuracy of ``score >= t``; ties -> lowest t.

    No cross join and no dense grid: each row falls in one bucket kk = max{k : t_k <=
    score} (-1 if none) of each grid; per-bucket class counts are a partial aggregation. The set of
    rows called OVER only changes when k passes an occupied bucket, so the lowest k of
    every constant stretch is 0 or (occupied bucket + 1); their accuracies come from
    running sums in one window over at most K + 2 bucket rows per group and grid."""
    s = F.col(score)

    def bucket(name: str, lo: int, hi: int, step: int, den: int) -> Column:
        def t(k: Column) -> Column:
            return (F.lit(lo) + k * step).cast("double") / float(den)

        guess = F.floor((s * den - lo) / step).cast("int")
        kk = F.when(t(guess + 1) <= s, guess + 1).when(t(guess) > s, guess - 1).otherwise(guess)
        kmax = (hi - lo) // step
        kk = F.when(s.isNull(), F.lit(-1)).otherwise(F.least(F.greatest(kk, F.lit(-1)), F.lit(kmax)))
        return F.struct(F.lit(name).alias("grid"), F.lit(lo).alias("_lo"), F.lit(step).alias("_step"),
                        F.lit(den).alias("_den"), F.lit(kmax).alias("_kmax"), kk.alias("k"))

    group = [*keys, "grid", "_lo", "_step", "_den", "_kmax"]
    buckets = (train.select(*keys, F.col(label).alias("y"), F.inline(F.array(*[bucket(n, *g) for n, g in grids.items()])))
                    .groupBy(*group, "k")
                    .agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))
    w_all = Window.partitionBy(*group)
    w_cum = w_all.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cum = buckets.select(*group, "k", F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"),
                         F.sum("pos").over(w_cum).alias("pos_le"), F.sum("neg").over(w_cum).alias("neg_le"),
                         F.min("k").over(w_all).alias("k_min"))
    # candidate k + 1 after every occupied bucket; candidate 0 when no row is below the grid
    cands = F.array(
        F.struct((F.col("k") + 1).alias("kc"), (F.col("P") - F.col("pos_le")).alias("pos_ge"),
                 F.col("neg_le").alias("neg_lt")),
        F.struct(F.when((F.col("k") == F.col("k_min")) & (F.col("k") >= 0), F.lit(0)).alias("kc"),
                 F.col("P").alias("pos_ge"), F.lit(0).cast("bigint").alias("neg_lt")))
    acc = (cum.select(*group, "P", "N", F.inline(cands))
              .filter(F.col("kc").isNotNull() & (F.col("kc") <= F.col("_kmax")))
              .withColumn("correct", F.col("pos_ge") + F.col("neg_lt")))
    best_w = w_all.orderBy(F.col("correct").desc(), F.col("kc").asc())
    best = acc.withColumn("_rn", F.row_number().over(best_w)).filter(F.col("_rn") == 1)
    return best.select(*keys, "grid", ((F.col("_lo") + F.col("kc") * F.col("_step")).cast("double") / F.col("_den")).alias("threshold"),
                       (F.col("P") + F.col("N")).alias("n_train"), F.col("correct").alias("n_correct_train"),
                       div(F.col("correct"), F.col("P") + F.col("N")).alias("train_accuracy"))


# ---------------------------------------------------------------------------
# Grouped logistic regression: Newton steps as one aggregation each
# ---------------------------------------------------------------------------

ETA_CLIP = 35.0          # |logit| beyond which p is 0 / 1 in double precision anyway
INTERCEPT_RIDGE = 1e-6   # tiny ridge on the intercept (a one-class group would diverge)


def fit_logistic_groups(spark: SparkSession, data: DataFrame, keys: list[str], features: list[str],
                        label: str = "label_over", c_reg: float = 1.0, max_iter: int = 25,
                        tol: float = 1e-9, checkpoint_input: bool = True,
                        c_col: str | None = None, grid: Column | None = None, held_out: tuple[str, str] | None = None) -> DataFrame:
    """L2-regularised logistic regression (intercept unpenalised, penalty |w|^2 / 2C) for
    every group at once, on already standardised columns ``z_<feature>``.

    Each Newton step joins the current coefficients (one row per group) and computes
    gradient and Hessian entries as one wide groupBy sum; the per-group (d+1)x(d+1)
    systems are solved where the sums are, one Arrow batch of groups at a time, and the new
    coefficients are checkpointed. Only the number of open groups reaches the driver.
    The first step starts from beta = 0 (p = 1/2) and needs no coefficients. The training rows
    are checkpointed once (unless the caller already did) so the lineage does not grow
    with the iterations. ``c_col`` names a group-key column holding each group's C, so
    a whole C grid is fitted in the same loop.

    ``grid`` is an array of structs whose fields are further keys: every row takes part in the group of each entry, but
    for those whose ``held_out`` fold (row column, grid field) is the row's own. Rows are kept once, not once per entry: the
    first step spreads them inside its tasks, later ones as they meet the coefficients of all entries of their group.
    These (a row per group and entry) are broadcast, so no step shuffles rows, only each task's sums.

    ``converged`` is False for a group whose system had no finite solution, or whose last
    step was not under ``tol``."""
    assert_no_leakage(features)
    d = len(features)
    own_keys = list(keys)   # keys that a row itself holds
    key_types = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    spread = lambda df: df
    if grid is not None:
        fields = data.select(F.inline(grid)).schema.fields
        key_types |= {f.name: f.dataType.simpleString() for f in fields}
        keys = own_keys + [f.name for f in fields]
    fold = [] if held_out is None else [held_out[0]]
    if held_out is not None:
        spread = lambda df: df.filter(F.col(held_out[0]) != F.col(held_out[1]))
    rows = data.select(*own_keys, *fold, *[F.col(f"z_{f}").alias(f"x{i + 1}") for i, f in enumerate(features)],
                       F.col(label).cast("double").alias("y"))
    if checkpoint_input:
        checkpoint_dir(spark)
        rows = rows.checkpoint()
    else:
        # the caller's lineage is already short (built on a checkpoint): keep the rows
        # across iterations without another write; a lost block is recomputed from it
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    xs = [F.lit(1.0)] + [F.col(f"x{i + 1}") for i in range(d)]
    betas = [f"b{i}" for i in range(d + 1)]

    def newton_sums(scored: DataFrame) -> DataFrame:
        r = F.col("p") - F.col("y")
        wgt = F.col("p") * (F.lit(1.0) - F.col("p"))
        aggs = [F.count(F.lit(1)).alias("n"), F.max("failed").alias("failed")] + [F.max(b).alias(b) for b in betas]
        aggs += [F.sum(r * xs[i]).alias(f"g{i}") for i in range(d + 1)]
        aggs += [F.sum(wgt * xs[i] * xs[j]).alias(f"h{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
        return scored.groupBy(*keys).agg(*aggs)

    def solve(batches):
        for s in batches:
            m = len(s)
            b = s[betas].to_numpy(dtype=float)
            grad = s[[f"g{i}" for i in range(d + 1)]].to_numpy(dtype=float)
            hess = np.empty((m, d + 1, d + 1))
            for i in range(d + 1):
                for j in range(i, d + 1):
                    hess[:, i, j] = hess[:, j, i] = s[f"h{i}_{j}"].to_numpy(dtype=float)
            c = s[c_col].to_numpy(dtype=float) if c_col else np.full(m, c_reg)
            pen = np.repeat(1.0 / c[:, None], d + 1, axis=1)
            pen[:, 0] = INTERCEPT_RIDGE  # keeps a one-class group's intercept finite
            grad = grad + pen * b
            hess[:, np.arange(d + 1), np.arange(d + 1)] += pen
            delta = np.full((m, d + 1), np.nan)
            for g in range(m):
                try:
                    delta[g] = np.linalg.solve(hess[g], grad[g])
                except np.linalg.LinAlgError:
                    pass  # stays NaN: the group has failed
            bad = ~np.isfinite(delta).all(axis=1)
            delta[bad] = 0.0
            out = s[keys].copy()
            out[betas] = b - delta
            out["n"], out["failed"] = s["n"], s["failed"].to_numpy(dtype=bool) | bad
            out["step"] = np.abs(delta).max(axis=1)
            yield out

    solved_schema = ", ".join([f"{k} {key_types[k]}" for k in keys] + [f"{b} double" for b in betas]
                              + ["n bigint", "failed boolean", "step double"])
    checkpoint_dir(spark)
    coefs, iters = None, 0
    for it in range(max_iter):
        iters = it + 1
        if it == 0:
            every = rows if grid is None else spread(rows.select("*", F.inline(grid)))
            scored = every.select("*", F.lit(0.5).alias("p"), F.lit(False).alias("failed"),
                                 *[F.lit(0.0).alias(b) for b in betas])
        else:
            eta = sum((F.col(b) * x for b, x in zip(betas, xs)), F.lit(0.0))
            eta = F.least(F.greatest(eta, F.lit(-ETA_CLIP)), F.lit(ETA_CLIP))  # no exp overflow
            known = coefs.drop("n", "step")
            met = rows.join(known, keys, "inner") if grid is None else spread(rows.join(F.broadcast(known), own_keys, "inner"))
            scored = met.withColumn(
                "p", F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)))
        coefs = newton_sums(scored).mapInPandas(solve, solved_schema).checkpoint()
        if coefs.filter(F.col("step") >= tol).isEmpty():
            break
    if not checkpoint_input:
        rows.unpersist()
    return coefs.select(*keys, F.col("b0").alias("intercept"), F.array(*[F.col(b) for b in betas[1:]]).alias("coef"),
                        F.col("n").alias("trained_n"), F.lit(iters).alias("iterations"),
                        (~F.col("failed") & (F.col("step") < tol)).alias("converged"))
