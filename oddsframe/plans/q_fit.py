"""Queries that fit models (rows-only checks: no SQL form)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.calendar import with_season_window
from oddsframe.operators import evaluate as EV
from oddsframe.operators import learn as L
from oddsframe.operators import matches as M
from oddsframe.operators import score as S
from oddsframe.plans.registry import register
from oddsframe.sources.registry import read_registry, shared_registry_path, write_registry
from oddsframe.session import checkpoint_dir
from oddsframe.sources.tables import fixture_tables


def _train_test(spark, d):
    """Gated split with history features, checkpointed once into the shared folder so
    the fits (iterative or multi-pass) never recompute the feature lineage."""
    t = fixture_tables(spark, d)
    checkpoint_dir(spark)
    sp = L.gated(L.chrono_split(L.train_frame(spark, t, with_history=True))).checkpoint()
    return sp.filter(F.col("is_train") == 1), sp.filter(F.col("is_train") == 0)


def _logit(coef_col: str, intercept_col: str, features: list[str]) -> F.Column:
    eta = F.col(intercept_col)
    for i, f in enumerate(features):
        eta = eta + F.col(coef_col)[i] * F.col(f"z_{f}")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


C_GRID = (0.01, 0.1, 1.0, 10.0)
N_FOLDS = 5


def logistic_registry(spark, d, features=L.FEATURES, name="logistic_l2"):
    """Per gated window: pick C from ``C_GRID`` by 5-fold stratified cross-validated
    accuracy on the train rows, refit on all train rows with that C, search the
    threshold on train probabilities. Every (window, C, held-out fold) model and every
    (window, C) model on all train rows is fitted in one Newton loop (group key)."""
    train, _test = _train_test(spark, d)
    folds = L.cv_folds(train, N_FOLDS).select("event_id", "fold")
    sw = L.stats_wide(train, L.WKEYS, features)
    z = L.standardized(train.join(folds, "event_id"), sw, L.WKEYS, features).persist(StorageLevel.MEMORY_AND_DISK)
    # fold -1 = all train rows: the final model of every C is fitted in the same loop
    grid = F.array(*[F.struct(F.lit(c).alias("c_reg"), F.lit(f).alias("cv_fold"))
                     for c in C_GRID for f in range(-1, N_FOLDS)])
    all_coefs = L.fit_logistic_groups(spark, z, L.WKEYS, features, c_col="c_reg", checkpoint_input=False, grid=grid,
                                      held_out=("fold", "cv_fold"))
    cv_coefs = all_coefs.filter(F.col("cv_fold") >= 0)
    held = z.join(F.broadcast(cv_coefs.withColumnRenamed("cv_fold", "fold")), L.WKEYS + ["fold"])
    correct = ((_logit("coef", "intercept", features) >= 0.5).cast("int") == F.col("label_over")).cast("double")
    cv_acc = held.groupBy(*L.WKEYS, "c_reg").agg(F.avg(correct).alias("cv_accuracy"))
    w = Window.partitionBy(*L.WKEYS).orderBy(F.col("cv_accuracy").desc(), F.col("c_reg").asc())
    best_c = cv_acc.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    coefs = (all_coefs.filter(F.col("cv_fold") == -1).join(F.broadcast(best_c.select(*L.WKEYS, "c_reg")),
                                                           L.WKEYS + ["c_reg"])
                      .drop("c_reg", "cv_fold"))
    scored = z.join(F.broadcast(coefs), L.WKEYS).withColumn("probability", _logit("coef", "intercept", features))
    thr = L.threshold_search(scored, L.WKEYS, score="probability")
    labels = train.select(*L.WKEYS, "window_label").distinct()
    reg = (coefs.join(F.broadcast(sw), L.WKEYS).join(F.broadcast(thr.select(*L.WKEYS, "threshold")), L.WKEYS)
                .join(F.broadcast(labels), L.WKEYS).join(F.broadcast(best_c), L.WKEYS))
    return reg.select(*L.WKEYS, "window_label", F.lit(name).alias("model_name"),
                      F.array(*[F.lit(f) for f in features]).alias("feature_cols"),
                      F.array(*[F.col(f"{f}__mean") for f in features]).alias("mean"),
                      F.array(*[F.col(f"{f}__std") for f in features]).alias("scale"),
                      "coef", "intercept", "threshold", F.col("trained_n").cast("bigint").alias("trained_n"),
                      "c_reg", "cv_accuracy", "converged")


@register("fit_logistic")
def fit_logistic(spark, d):
    """L2 logistic regression for every gated window at once (Newton steps as grouped
    aggregations), C chosen by 5-fold CV on train rows, threshold searched on train
    rows: the model registry."""
    return logistic_registry(spark, d)


@register("model_registry_scan")
def model_registry_scan(spark, d):
    """Registry written to the shared folder and scanned back with its fixed schema."""
    path = write_registry(logistic_registry(spark, d).drop("c_reg", "cv_accuracy"), shared_registry_path(spark))
    return read_registry(spark, path)


def request_frame(spark, t):
    """Matches with the latest quote, season window and feature map: what a prediction reads."""
    mf = M.match_frame(t)
    core = mf.select("event_id", "event_type_id", "start_time", "home_team", "away_team", "over_odd", "under_odd",
                     "over_under_cap", *L.market_columns())
    rows = with_season_window(core, spark).join(L.history_columns(spark, M.match_core(t)), "event_id", "left")
    pairs = [x for f in L.FEATURES for x in (F.lit(f), F.col(f))]
    return rows.withColumn("features", F.create_map(*pairs)).drop(*L.FEATURES)


@register("prediction_fitted")
def prediction_fitted(spark, d):
    """A record for every unplayed match from the fitted registry: the model of its window, else the
    league's fallback; features and errors as values."""
    t = fixture_tables(spark, d)
    registry = read_registry(spark, write_registry(logistic_registry(spark, d), shared_registry_path(spark)))
    policies = spark.createDataFrame(sorted(config.LEAGUE_FALLBACK.items()), "event_type_id int, policy string")
    requests = t.event.filter(~M.is_played()).select("event_id")
    return S.predict(requests, request_frame(spark, t), registry, policies,
                     routed=[lg for lg, row in config.LEAGUES.items() if row[1]],
                     strict=[lg for lg, row in config.LEAGUES.items() if row[3]])


def _ml_eval(spark, d, estimator, name):
    train, test = _train_test(spark, d)
    L.assert_no_leakage(L.FEATURES)
    # the league is a category: one column per league, never an ordered number
    pipe = Pipeline(stages=[OneHotEncoder(inputCols=["event_type_id"], outputCols=["league"], dropLast=False,
                                          handleInvalid="keep"),
                            VectorAssembler(inputCols=[*L.FEATURES, "league"], outputCol="features", handleInvalid="keep"),
                            estimator])
    if train.isEmpty():  # no window passes the gate: nothing to fit, empty typed result
        pred = test.withColumn("pred_over", F.lit(None).cast("int"))
        return None, EV.window_score(EV.settle(pred), L.WKEYS).withColumn("model_name", F.lit(name))
    model = pipe.fit(train)
    pred = model.transform(test).withColumn("pred_over", F.col("prediction").cast("int"))
    scores = EV.window_score(EV.settle(pred), L.WKEYS)
    return model, scores.withColumn("model_name", F.lit(name))


@register("fit_forest")
def fit_forest(spark, d):
    """Random forest on the pooled train rows of all gated windows; test accuracy and ROI
    per window."""
    est = RandomForestClassifier(labelCol="label_over", featuresCol="features", numTrees=50, maxDepth=4, seed=42)
    return _ml_eval(spark, d, est, "random_forest")[1]


@register("fit_gbt")
def fit_gbt(spark, d):
    """Gradient-boosted trees on the pooled train rows; test accuracy and ROI per window."""
    est = GBTClassifier(labelCol="label_over", featuresCol="features", maxIter=30, maxDepth=3, seed=42)
    return _ml_eval(spark, d, est, "gbt")[1]


@register("feature_importance")
def feature_importance(spark, d):
    """Random-forest importances and mean |coefficient| of the windowed logistic models."""
    model, _ = _ml_eval(spark, d, RandomForestClassifier(labelCol="label_over", featuresCol="features",
                                                         numTrees=50, maxDepth=4, seed=42), "random_forest")
    imp = model.stages[-1].featureImportances.toArray().tolist() if model is not None else []
    own = len(L.FEATURES)
    imp = imp[:own] + [sum(imp[own:])] if imp else []  # the league's columns count together
    rf = spark.createDataFrame([("random_forest", c, float(v)) for c, v in zip([*L.FEATURES, "event_type_id"], imp)],
                               "model_name string, feature string, importance double")
    reg = logistic_registry(spark, d)
    lr = (reg.select(F.posexplode("coef").alias("i", "w"), "feature_cols")
             .select(F.col("feature_cols")[F.col("i")].alias("feature"), F.abs("w").alias("aw"))
             .groupBy("feature").agg(F.avg("aw").alias("importance"))
             .select(F.lit("logistic_l2").alias("model_name"), "feature", "importance"))
    w = Window.partitionBy("model_name").orderBy(F.col("importance").desc())
    return rf.unionByName(lr).withColumn("rank", F.row_number().over(w))


@register("feature_sets")
def feature_sets(spark, d):
    """odds_only / odds_plus_market / full feature sets fitted for every gated window in
    one Newton loop (the set and the held-out fold are part of the group key; absent features are
    zero columns, which the L2 penalty keeps at weight 0); best set per window by 5-fold
    cross-validated accuracy at 0.5 on the train rows, so that a larger set has no head start."""
    train, _test = _train_test(spark, d)
    feats = L.FEATURES
    sw = L.stats_wide(train, L.WKEYS, feats)
    folds = L.cv_folds(train, N_FOLDS).select("event_id", "fold")
    z = L.standardized(train.join(folds, "event_id"), sw, L.WKEYS, feats)
    sets = list(L.FEATURE_SETS.items())
    set_rows = spark.createDataFrame([(i, name) for i, (name, _f) in enumerate(sets)], "set_id int, feature_set string")
    # one copy per feature set (a generator, not a join)
    zz = z.withColumn("set_id", F.explode(F.array(*[F.lit(i) for i in range(len(sets))])))
    for f in feats:
        member = [i for i, (_n, fs) in enumerate(sets) if f in fs]
        zz = zz.withColumn(f"z_{f}", F.when(F.col("set_id").isin(member), F.col(f"z_{f}")).otherwise(F.lit(0.0)))
    keys = L.WKEYS + ["set_id"]
    zz = zz.checkpoint()
    grid = F.array(*[F.struct(F.lit(k).alias("cv_fold")) for k in range(N_FOLDS)])
    coefs = L.fit_logistic_groups(spark, zz, keys, feats, checkpoint_input=False, grid=grid, held_out=("fold", "cv_fold"))
    scored = (zz.withColumnRenamed("fold", "cv_fold").join(coefs, keys + ["cv_fold"])
                .withColumn("p", _logit("coef", "intercept", feats)))
    acc = (scored.groupBy(*keys).agg(F.avg(((F.col("p") >= 0.5).cast("int") == F.col("label_over")).cast("double"))
                                     .alias("cv_accuracy"))
                 .join(F.broadcast(set_rows), "set_id"))
    w = Window.partitionBy(*L.WKEYS).orderBy(F.col("cv_accuracy").desc(), F.col("set_id"))
    return acc.withColumn("is_best", (F.row_number().over(w) == 1).cast("int")).select(
        *L.WKEYS, "feature_set", "cv_accuracy", "is_best")
