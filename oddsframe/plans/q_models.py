"""Queries of models fitted on the leagues' own feature vectors: trees, forests and boosting per window, the choice among
families, and predictions from the registry of chosen models."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.calendar import with_season_window
from oddsframe.operators import evaluate as EV
from oddsframe.operators import features as FT
from oddsframe.operators import learn as L
from oddsframe.operators import matches as M
from oddsframe.operators import models as MD
from oddsframe.operators import score as S
from oddsframe.operators import trees as T
from oddsframe.plans.q_features import RESOLVED
from oddsframe.plans.q_learn import GATE, LEARN_CTES, WK
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import P_OVER_FAIR, rr6
from oddsframe.session import stored
from oddsframe.sources.registry import MODEL_SCHEMA, read_registry, shared_registry_path, write_registry
from oddsframe.sources.tables import fixture_tables
from oddsframe.vectors import LEAGUE_VECTORS

# the vector that a league's models are fitted on: the first that is dealt to it
OF_LEAGUE = {league: names[0] for league, names in LEAGUE_VECTORS.items()}
VECTORS = {v.name: v for v in RESOLVED}
KEYS = MD.KEYS


def _rows(spark, d):
    return MD.vector_rows(spark, fixture_tables(spark, d), RESOLVED, OF_LEAGUE)


def _names(spark):
    return spark.createDataFrame([(league, list(VECTORS[n].features)) for league, n in sorted(OF_LEAGUE.items())],
                                 "event_type_id int, feature_names array<string>")


def _scores(test, model_name):
    """Accuracy and return per window of rows with ``probability`` and ``threshold``."""
    pred = test.withColumn("pred_over", (F.col("probability") >= F.col("threshold")).cast("int"))
    return EV.window_score(EV.settle(pred), KEYS).withColumn("model_name", model_name)


@register("training_status", f"""SELECT w.*, CAST(coalesce(c.n_completed, 0) AS BIGINT) AS n_league, CAST({GATE} AS INT) AS min_window,
  CASE WHEN coalesce(c.n_completed, 0) < {config.LEAGUE_MIN_MATCHES} THEN 'league too small' WHEN n_window < {GATE} THEN 'window too small'
       ELSE 'trained' END AS status
FROM (SELECT {WK}, window_label, count(*) AS n_window FROM tf GROUP BY ALL) w LEFT JOIN completed c USING (event_type_id)""", LEARN_CTES)
def training_status(spark, d):
    """Every season window with its size, its league's, and why it is trained on or not."""
    t = fixture_tables(spark, d)
    return L.training_status(L.train_frame(spark, t), L.league_sizes(t))


@register("select_k_20")
def select_k_20(spark, d):
    """The 20 features of highest ANOVA F of every gated window, from the league's whole vector, on train rows."""
    chosen = MD.k_best(_rows(spark, d).filter("is_train = 1"), KEYS)
    return (chosen.join(_names(spark), "event_type_id").select(*KEYS, "chosen", "feature_names", F.posexplode("scores").alias("place", "f_score"))
            .select(*KEYS, F.get("feature_names", F.col("place")).alias("feature"), "place", "f_score",
                    F.array_contains("chosen", F.col("place")).cast("int").alias("selected")))


@register("forest_windows")
def forest_windows(spark, d):
    """A random forest for every gated window, all grown at once; test accuracy and return."""
    rows = _rows(spark, d)
    forest = T.fit_forest_groups(rows.filter("is_train = 1"), KEYS, trees=20, depth=4)
    test = rows.filter("is_train = 0").join(forest, KEYS).withColumn("probability", T.forest_probability(F.col("trees"), F.col("x")))
    return _scores(test.withColumn("threshold", F.lit(config.DEFAULT_THRESHOLD)), F.lit("forest_window"))


@register("boosting_losses")
def boosting_losses(spark, d):
    """Boosted trees for every gated window: the train loss after each stage until the window closes."""
    return T.fit_boosted_groups(spark, _rows(spark, d).filter("is_train = 1"), KEYS, **MD.BOOST)[1].select(*KEYS, "stage", "loss")


def _fitted(spark, d):
    rows = _rows(spark, d)
    reg, table = MD.fit(spark, rows, _names(spark))
    return rows, read_registry(spark, write_registry(reg, shared_registry_path(spark), MODEL_SCHEMA), MODEL_SCHEMA), table


@register("model_choice")
def model_choice(spark, d):
    """Cross-validated accuracy of every family and parameter set per window, and the one chosen."""
    ready, _chosen, _scale = MD.prepared(spark, _rows(spark, d))
    return MD.best_candidate(MD.cv_table(ready, MD.candidates(spark, ready)))


@register("window_models")
def window_models(spark, d):
    """Every season window: the model chosen for it (family, parameters, its 20 features), its test accuracy and return, or why
    there is none."""
    t = fixture_tables(spark, d)
    status = L.training_status(L.train_frame(spark, t), L.league_sizes(t)).select(*KEYS, "window_label", "n_window", "status")
    rows, reg, _table = _fitted(spark, d)
    names = _names(spark)
    test = rows.filter("is_train = 0").join(names, "event_type_id").join(reg.drop("window_label"), KEYS)
    mapped = F.map_from_arrays("feature_names", "x")
    scored = test.withColumn("probability", MD.score(MD.features_of(mapped, F.col("feature_cols"))))
    found = (_scores(scored, F.lit("chosen")).drop("model_name")
             .join(reg.select(*KEYS, "model_name", "parameters", "cv_accuracy", "threshold", "trained_n",
                             F.array_join("feature_cols", ",").alias("features"), F.size("feature_cols").alias("n_features")), KEYS, "right"))
    return status.join(found, KEYS, "left")


@register("prediction_models")
def prediction_models(spark, d):
    """A record for every unplayed match from the registry of chosen models, linear or trees, with the window fallback."""
    t = fixture_tables(spark, d)
    _rows_, reg, _table = _fitted(spark, d)
    mf = M.match_frame(t)
    used = [VECTORS[n] for n in OF_LEAGUE.values()]
    x = FT.assemble(FT.feature_frame(spark, mf, used), used, {league: (n,) for league, n in OF_LEAGUE.items()})
    named = (x.join(mf.select("event_id", "event_type_id"), "event_id").join(_names(spark), "event_type_id")
             .select("event_id", F.map_from_arrays("feature_names", "values").alias("features")))
    core = mf.select("event_id", "event_type_id", "start_time", "home_team", "away_team", "over_odd", "under_odd", "over_under_cap")
    frame = with_season_window(core, spark).join(named, "event_id", "left")
    policies = spark.createDataFrame(sorted(config.LEAGUE_FALLBACK.items()), "event_type_id int, policy string")
    return S.predict(t.event.filter(~M.is_played()).select("event_id"), frame, reg, policies,
                     routed=[lg for lg, row in config.LEAGUES.items() if row[1]],
                     strict=[lg for lg, row in config.LEAGUES.items() if row[3]],
                     probability=MD.score(MD.features_of(F.col("features"), F.col("feature_cols"))))


# ---------------------------------------------------------------------------
# With an SQL text: a tree of two levels for every window, and the walk of given trees
# ---------------------------------------------------------------------------
_TREE_ROWS = f"""SELECT event_id, event_type_id, season_start, window_no, label_over AS y, p_over_fair AS x0,
  over_under_cap AS x1, over_odd AS x2 FROM sp2 WHERE is_train = 1 AND n_window >= {GATE}"""
_AT = WK


def _level(rows: str, by: str) -> str:
    """Best split of every node of ``rows`` (columns y, x0..x2, node): its feature and cut, ties to the smaller."""
    return f"""SELECT {by}, arg_min(struct_pack(f := f, cut := cut), struct_pack(g := -gain, f := f, cut := cut)) AS s
FROM (SELECT {by}, f, cut, CAST(yl AS DOUBLE) * yl / nl + CAST(y - yl AS DOUBLE) * (y - yl) / (n - nl) - CAST(y AS DOUBLE) * y / n AS gain
  FROM (SELECT {by}, f, cut, sum(y) AS y, count(*) AS n, sum(CASE WHEN x <= cut THEN y ELSE 0 END) AS yl,
               count(*) FILTER (WHERE x <= cut) AS nl
        FROM (SELECT r.*, unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS x FROM {rows} r) r
        JOIN tree_cuts USING ({_AT}, f) GROUP BY {by}, f, cut)
  WHERE nl >= 5 AND n - nl >= 5)
WHERE gain > 1e-7 GROUP BY {by}"""


_CUTS = ", ".join(f"{i / T.BINS}" for i in range(1, T.BINS))
_TREE_CTES = LEARN_CTES + (
    ("tree_rows", _TREE_ROWS),
    ("tree_cuts", f"""SELECT {_AT}, f, unnest(list_distinct(quantile_disc(x, [{_CUTS}]))) AS cut
FROM (SELECT r.*, unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS x FROM tree_rows r) GROUP BY {_AT}, f"""),
    ("tree_0", "SELECT *, 0 AS node FROM tree_rows"),
    ("split_0", _level("tree_0", f"{_AT}, node")),
    ("tree_1", f"""SELECT t.* REPLACE (CASE WHEN [x0, x1, x2][s.f + 1] <= s.cut THEN 1 ELSE 2 END AS node)
FROM tree_0 t JOIN split_0 USING ({_AT}, node)"""),
    ("split_1", _level("tree_1", f"{_AT}, node")),
    ("tree_2", f"""SELECT t.* REPLACE (2 * node + CASE WHEN [x0, x1, x2][s.f + 1] <= s.cut THEN 1 ELSE 2 END AS node)
FROM tree_1 t JOIN split_1 USING ({_AT}, node)"""),
    ("tree_all", "SELECT * FROM tree_0 UNION ALL SELECT * FROM tree_1 UNION ALL SELECT * FROM tree_2"),
    ("split_all", "SELECT * FROM split_0 UNION ALL SELECT * FROM split_1"))


@register("window_tree", f"""SELECT {_AT}, CAST(node AS INT) AS node, CAST(coalesce(any_value(s.f), -1) AS INT) AS feature,
  {rr6('coalesce(any_value(s.cut), 0)')} AS threshold, {rr6('CAST(sum(y) AS DOUBLE) / count(*)')} AS value, count(*) AS n
FROM tree_all LEFT JOIN split_all USING ({_AT}, node) GROUP BY {_AT}, node""", _TREE_CTES, rounded=True)
def window_tree(spark, d):
    """A decision tree of two levels for every gated window over three market features: its nodes."""
    train = L.gated(L.chrono_split(L.train_frame(spark, fixture_tables(spark, d)))).filter("is_train = 1")
    rows = train.select(*KEYS, "event_id", F.col("label_over").alias("y"),
                        F.array("p_over_fair", "over_under_cap", "over_odd").alias("x")).transform(stored, "models")
    cut = T.edges(rows, KEYS).transform(stored, "models")
    nodes = T.grow(T.with_bins(rows, cut, KEYS), KEYS, 1, 2, T.class_statistics(bagged=False), min_rows=5)
    limit = F.get(F.get("edges", F.col("feature")), F.col("bin"))
    return nodes.join(cut, KEYS).select(*KEYS, "node", "feature",
                                        F.when(F.col("feature") >= 0, limit).otherwise(F.lit(0.0)).alias("threshold"), "value", "n")


# Trees of a fixed ensemble (repository choice): node -> (feature, threshold, value); features: fair over probability, cap, over odd
LITERAL_TREES = [
    {0: (0, 0.5, 0.0), 1: (1, 2.5, 0.0), 2: (2, 1.75, 0.0), 3: (-1, 0.0, 0.35), 4: (-1, 0.0, 0.2), 5: (-1, 0.0, 0.8), 6: (-1, 0.0, 0.6)},
    {0: (1, 2.75, 0.0), 1: (0, 0.45, 0.0), 2: (-1, 0.0, 0.25), 3: (-1, 0.0, 0.4), 4: (-1, 0.0, 0.7)},
    {0: (-1, 0.0, 0.5)},
]
_NODES = ", ".join(f"({t}, {n}, {f}, {c}E0, {v}E0)" for t, tree in enumerate(LITERAL_TREES) for n, (f, c, v) in tree.items())
_WALK = """SELECT event_id, t.tree, CAST(0 AS INT) AS node FROM lt_rows CROSS JOIN (SELECT DISTINCT tree FROM lt) t
UNION ALL
SELECT w.event_id, w.tree, CAST(2 * w.node + CASE WHEN [x0, x1, x2][lt.feature + 1] > lt.threshold THEN 2 ELSE 1 END AS INT)
FROM lt_walk w JOIN lt ON lt.tree = w.tree AND lt.node = w.node AND lt.feature >= 0 JOIN lt_rows r ON r.event_id = w.event_id"""


@register("score_trees", f"""SELECT w.event_id, {rr6('sum(lt.value) / count(*)')} AS probability,
  CASE WHEN sum(lt.value) / count(*) >= 0.5 THEN 'OVER' ELSE 'UNDER' END AS prediction
FROM lt_walk w JOIN lt ON lt.tree = w.tree AND lt.node = w.node AND lt.feature < 0 GROUP BY w.event_id""", (
    ("lt", f"SELECT * FROM (VALUES {_NODES}) AS v(tree, node, feature, threshold, value)"),
    ("lt_rows", f"SELECT event_id, {P_OVER_FAIR} AS x0, over_under_cap AS x1, over_odd AS x2 FROM mf WHERE over_odd IS NOT NULL"),
    ("lt_walk", _WALK)), rounded=True)
def score_trees(spark, d):
    """Every quoted match scored by an ensemble of fixed trees, walked inside the JVM."""
    size = max(max(t) for t in LITERAL_TREES) + 1
    leaf = (-1, 0.0, 0.0)
    trees = F.array(*[F.struct(*[F.array(*[F.lit(t.get(i, leaf)[j]) for i in range(size)]).alias(name)
                                 for j, name in enumerate(("feature", "threshold", "value"))]) for t in LITERAL_TREES])
    rows = M.match_frame(fixture_tables(spark, d)).filter(F.col("over_odd").isNotNull()).select(
        "event_id", *L.market_columns(), "over_under_cap", "over_odd")
    p = T.forest_probability(trees, F.array("p_over_fair", "over_under_cap", "over_odd"))
    return rows.select("event_id", p.alias("probability"), F.when(p >= 0.5, F.lit("OVER")).otherwise(F.lit("UNDER")).alias("prediction"))
