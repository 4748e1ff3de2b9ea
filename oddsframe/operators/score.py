"""Scoring and decisions: feature assembly, logistic scoring against a registry,
threshold decisions, bet recommendation and the prediction record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsframe import config
from oddsframe.functions.helpers import div
from oddsframe.operators.prefix import time_prefix

ID_BUCKET = 1 << 12  # width of the buckets in which integral team ids are ranked

# ---------------------------------------------------------------------------
# Fixture registry (FIXTURES.md §3 "registry_literal"): one model row per fixture league
# with fixed mean, std, coefficient, intercept and threshold, chosen by this repository
# (the original pickled models are not available) so that scoring and decisions have an
# exact oracle without fitting. Fitted registries come from ``fit_logistic``.
# feature order: p_over_fair, ou_overround, cap_minus_25, ou_odds_ratio
# ---------------------------------------------------------------------------
LITERAL_FEATURES = ["p_over_fair", "ou_overround", "cap_minus_25", "ou_odds_ratio"]
LITERAL_REGISTRY = [
    # league, model_name, intercept, threshold, means, stds, coefs
    (1, "logistic_l1", -0.05, 0.50, (0.49, 1.12, 0.25, 1.10), (0.06, 0.05, 0.50, 0.25), (0.80, -0.10, -0.30, -0.20)),
    (2, "logistic_l2", 0.02, 0.48, (0.49, 1.12, 0.25, 1.10), (0.06, 0.05, 0.50, 0.25), (0.60, 0.05, -0.25, -0.10)),
    (3, "logistic_l3", 0.00, 0.52, (0.50, 1.11, 0.25, 1.05), (0.05, 0.05, 0.45, 0.20), (0.70, -0.05, -0.35, -0.15)),
    (4, "logistic_l4", -0.10, 0.50, (0.48, 1.13, 0.30, 1.12), (0.07, 0.06, 0.50, 0.30), (0.90, 0.00, -0.20, -0.30)),
    (5, "logistic_l5", 0.05, 0.46, (0.49, 1.12, 0.25, 1.10), (0.06, 0.05, 0.50, 0.25), (0.50, 0.10, -0.40, -0.05)),
]


def literal_registry(spark: SparkSession) -> DataFrame:
    """Long form: league, model_name, intercept, threshold, strict, feature, mean, std, coef."""
    rows = []
    for lg, name, b, thr, means, stds, coefs in LITERAL_REGISTRY:
        strict = config.LEAGUES[lg][3]
        for f, m, s, w in zip(LITERAL_FEATURES, means, stds, coefs):
            rows.append((lg, name, b, thr, strict, f, m, s, w))
    return spark.createDataFrame(rows, "event_type_id int, model_name string, intercept double, "
                                       "threshold double, strict boolean, feature string, mean double, "
                                       "std double, coef double")


def encode_teams(events: DataFrame, seen: Column) -> DataFrame:
    """Team id -> index over the sorted ids of teams with a ``seen`` (e.g. played) match; every other team
    gets the extra 'keep' index (= number of seen teams). A team's index is the number of seen ids before its own:
    ids are ranked inside buckets of neighbouring ids and the buckets' totals are added, so no task holds
    all teams; the vocabulary is joined, and broadcast only where its measured size allows."""
    sides = F.array(F.struct(F.col("home_id").alias("team_id"), seen.cast("int").alias("seen")),
                    F.struct(F.col("away_id").alias("team_id"), seen.cast("int").alias("seen")))
    ids = (events.select(F.inline(sides)).groupBy("team_id").agg(F.max("seen").alias("seen"))
                 .filter(F.col("team_id").isNotNull())
                 # unseen teams come after all seen ones, so the seen ids before them are all
                 .select("seen", F.struct((F.lit(1) - F.col("seen")).alias("unseen"), "team_id").alias("at")))
    team = F.col("at")["team_id"]
    text = isinstance(ids.schema["at"].dataType["team_id"].dataType, T.StringType)
    bucket = F.struct(F.col("at")["unseen"], F.substring(team, 1, 4) if text else F.floor(team / ID_BUCKET))
    rank = time_prefix(ids, [], "at", {"n": F.col("seen")}, bucket)
    vocab = rank.select(team.alias("team_id"), F.col("n_before").cast("int").alias("idx"))
    h = vocab.select(F.col("team_id").alias("home_id"), F.col("idx").alias("home_idx"))
    a = vocab.select(F.col("team_id").alias("away_id"), F.col("idx").alias("away_idx"))
    return (events.select("event_id", "home_id", "away_id").join(h, "home_id", "left")
                  .join(a, "away_id", "left").select("event_id", "home_idx", "away_idx"))


def resolve_model_windows(models: DataFrame, requests: DataFrame, policies: DataFrame) -> DataFrame:
    """Model window for each request row (event_type_id, o = ordered window key): the
    exact window if it has a model, else by the league's policy: previous_then_last
    (latest earlier model window, else the last), last, first, or an error value.

    As-of without pairs: model and request windows are unioned per league and a running
    ``last(model, ignorenulls)`` over the window order finds the previous model. The
    resolution table has one row per distinct request window (bounded by leagues x
    windows), so it is broadcast back to the request rows."""
    from pyspark.sql import Window
    m = models.select("event_type_id", "o", F.lit(1).alias("is_model"))
    r = requests.select("event_type_id", "o").distinct().withColumn("is_model", F.lit(0))
    both = m.unionByName(r)
    w_prev = Window.partitionBy("event_type_id").orderBy("o", F.col("is_model").desc()) \
                   .rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy("event_type_id")
    model_o = F.when(F.col("is_model") == 1, F.col("o"))
    res = (both.select("event_type_id", "o", "is_model",
                       F.max(model_o).over(w_all).alias("last_o"), F.min(model_o).over(w_all).alias("first_o"),
                       F.last(model_o, ignorenulls=True).over(w_prev).alias("prev_o"))
               .groupBy("event_type_id", "o")
               .agg(F.max("is_model").alias("exact"), F.max("prev_o").alias("prev_o"),
                    F.max("last_o").alias("last_o"), F.max("first_o").alias("first_o")))
    out = (requests.join(F.broadcast(res), ["event_type_id", "o"], "left")
                   .join(F.broadcast(policies), "event_type_id", "left"))
    pol, exact = F.col("policy"), F.col("exact") == 1
    key = (F.when(exact, F.col("o"))
            .when(pol == "previous_then_last", F.coalesce(F.col("prev_o"), F.col("last_o")))
            .when(pol == "last", F.col("last_o")).when(pol == "first", F.col("first_o")))
    kind = (F.when(exact, F.lit("exact"))
             .when((pol == "previous_then_last") & F.col("prev_o").isNotNull(), F.lit("previous"))
             .when(pol.isin("previous_then_last", "last") & F.col("last_o").isNotNull(), F.lit("last"))
             .when((pol == "first") & F.col("first_o").isNotNull(), F.lit("first"))
             .otherwise(F.lit("error: no model")))
    return out.select(*requests.columns, key.cast("int").alias("model_key"), kind.alias("fallback"))


def feature_long(df: DataFrame, key: list[str], features: list[str]) -> DataFrame:
    """Wide features -> (key..., feature, value) via stack (one generator, no shuffle)."""
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    return df.selectExpr(*key, f"stack({len(features)}, {stack}) AS (feature, value)")


def score_logistic(df: DataFrame, registry: DataFrame, features: list[str],
                   key: str = "event_id", group: str = "event_type_id") -> DataFrame:
    """p = 1 / (1 + exp(-(b + sum_j w_j (x_j - mean_j) / std_j))) for every row.

    The registry (one row per league and feature: bounded by the model configuration)
    is pivoted to one wide row per league and broadcast, so scoring is a map-side join
    plus column arithmetic, in feature order, inside whole-stage codegen."""
    aggs = [F.first("model_name").alias("model_name"), F.first("intercept").alias("intercept"),
            F.first("threshold").alias("threshold"), F.first("strict").alias("strict")]
    for f in features:
        for part in ("mean", "std", "coef"):
            aggs.append(F.max(F.when(F.col("feature") == f, F.col(part))).alias(f"{f}__{part}"))
    wide = registry.groupBy(group).agg(*aggs)
    j = df.join(F.broadcast(wide), group, "inner")
    eta: Column = F.col("intercept")
    for f in features:
        eta = eta + F.col(f"{f}__coef") * F.coalesce(div(F.col(f) - F.col(f"{f}__mean"), F.col(f"{f}__std")),
                                                        F.when(F.col(f).isNotNull(), F.lit(0.0)))
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
    keep = [c for c in df.columns]
    return j.select(*keep, "model_name", "threshold", "strict", prob.alias("probability"))


def score_registry(rows: DataFrame, missing: float = 0.0) -> Column:
    """Probability of OVER from a registry row beside the request: ``features`` (map), and the
    registry's ``feature_cols``, ``mean``, ``scale``, ``coef`` and ``intercept``. A feature that the map lacks
    or holds as null takes the value ``missing``; one without spread adds nothing."""
    def term(s: Column) -> Column:
        x = F.coalesce(F.try_element_at(F.col("features"), s["feature_cols"]), F.lit(missing))
        return s["coef"] * F.coalesce(div(x - s["mean"], s["scale"]), F.lit(0.0))

    terms = F.transform(F.arrays_zip("feature_cols", "mean", "scale", "coef"), term)
    eta = F.aggregate(terms, F.col("intercept"), lambda a, b: a + b)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(eta, F.lit(-35.0)), F.lit(35.0))))


def predict(requests: DataFrame, frame: DataFrame, registry: DataFrame, policies: DataFrame,
            routed: list[int], strict: list[int], missing: float = 0.0, probability: Column | None = None) -> DataFrame:
    """One prediction record per request row (``event_id``), errors as values.

    ``frame`` holds the matches (odds, season window and a ``features`` map), ``registry`` the fitted models. The
    model is that of the match's window, else the one its league's policy names
    (``resolve_model_windows``); a model without a threshold takes the default one. ``error`` says why a
    request has no prediction (``probability``: the score of a registry of another shape): event not found, unsupported league, no over/under odds, or no model."""
    order = (F.col("season_start") * 10 + F.col("window_no")).cast("int")
    asked = requests.select("event_id").join(frame.withColumn("_found", F.lit(True)), "event_id", "left")
    league = F.col("event_type_id")
    why = (F.when(F.col("_found").isNull(), F.lit("event not found"))
            .when(~F.coalesce(league.isin(routed), F.lit(False)), F.lit("unsupported league"))
            .when(F.col("over_odd").isNull() | F.col("under_odd").isNull(), F.lit("no over/under odds")))
    asked = asked.withColumn("o", order).withColumn("_why", why)
    models = registry.withColumn("model_key", order).drop("season_start", "window_no").withColumnRenamed(
        "window_label", "model_window")
    found = resolve_model_windows(models.select("event_type_id", F.col("model_key").alias("o")), asked, policies)
    j = found.join(models, ["event_type_id", "model_key"], "left")
    error = F.coalesce(F.col("_why"), F.when(F.col("model_name").isNull(), F.lit("no model")))
    j = j.withColumn("error", error).withColumn("threshold", F.coalesce("threshold", F.lit(config.DEFAULT_THRESHOLD)))
    p = score_registry(j, missing) if probability is None else probability
    j = j.withColumn("p", F.when(F.col("error").isNull(), p))
    side = decide(F.col("p"), F.col("threshold"), F.coalesce(league.isin(strict), F.lit(False)))
    confidence, bet = recommended_bet(F.col("p"), side)
    ok = F.col("error").isNull()
    return j.select("event_id", "event_type_id", "home_team", "away_team", "start_time", side.alias("prediction"),
                    round_to(F.col("p"), config.ROUND_OUTPUT).alias("probability"),
                    F.when(ok, F.col("threshold")).alias("threshold"), round_to(confidence, config.ROUND_OUTPUT).alias("confidence"),
                    bet.alias("bet"), "over_odd", "under_odd", "over_under_cap", "window_label",
                    *[F.when(ok, F.col(c)).alias(c) for c in ("model_name", "model_window", "fallback")], "features", "error")


def decide(prob: Column, threshold: Column, strict: Column) -> Column:
    """OVER when p > t (strict predictors) or p >= t (the others)."""
    over = F.when(strict, prob > threshold).otherwise(prob >= threshold)
    return F.when(prob.isNull(), F.lit(None)).when(over, F.lit("OVER")).otherwise(F.lit("UNDER"))


def recommended_bet(prob: Column, prediction: Column,
                    min_conf: float = config.BET_MIN_CONFIDENCE) -> tuple[Column, Column]:
    conf = F.abs(prob - 0.5) * 2
    bet = F.when(prob.isNull(), F.lit(None)).when(conf > min_conf, prediction).otherwise(F.lit("SKIP"))
    return conf, bet


def round_to(x: Column, dp: int) -> Column:
    """floor(x * 10^dp + 0.5) / 10^dp (engine-neutral printing of probabilities)."""
    s = float(10 ** dp)
    return F.floor(x * s + 0.5) / s
