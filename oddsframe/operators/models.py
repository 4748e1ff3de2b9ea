"""Models of unlike families for every season window, and the choice among them by cross-validation.

Rows are (league, season, window) groups with the league's feature vector as an array. Per group the ``k`` features of
highest ANOVA F on train rows are kept; logistic regressions, forests and boosted trees are fitted on the same rows and folds, every
candidate is a row (family, parameters, fold), and the best family by accuracy on held-out folds is refitted on all
train rows. Test rows are never read by a fit or a choice.

One registry row holds a model of any family: linear ones fill ``coef``, tree ones ``trees``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.helpers import div
from oddsframe.operators import blocks as B
from oddsframe.operators import features as FT
from oddsframe.operators import history as H
from oddsframe.operators import learn as L
from oddsframe.operators import matches as M
from oddsframe.operators import trees as T
from oddsframe.session import stored
from oddsframe.sources.tables import Tables

KEYS = L.WKEYS
K_BEST, FOLDS = 20, 5
C_GRID = (0.01, 0.1, 1.0, 10.0)
FOREST = {"trees": 8, "depth": 3}
BOOST = {"stages": 6, "depth": 2, "rate": 0.3}
ETA = 35.0
REGISTRY = ("feature_cols array<string>, mean array<double>, scale array<double>, coef array<double>, intercept double, "
            f"trees array<{T.TREE}>, base double, rate double")


def vector_rows(spark: SparkSession, t: Tables, vectors: list[FT.Vector], of_league: dict[int, str]) -> DataFrame:
    """Split rows of the windows and leagues that pass their gates, with ``x`` (the league's vector, missing values 0) and ``y``; quotes and history from
    before the kick-off only."""
    used = [v for v in vectors if v.name in of_league.values()]
    # the matches are written once, for the vectors, the split and the league gate
    m = M.match_frame(t, quote_policy="asof").transform(stored, "asof-matches")
    known = FT.feature_columns(spark, m, used)
    large = L.league_sizes(t, m).filter(F.col("n_league") >= config.LEAGUE_MIN_MATCHES)
    split = L.gated(L.chrono_split(L.train_frame(spark, t, matches=m), H.written)).join(large, "event_type_id", "left_semi")
    # vectors are made of the rows of the split only, behind the join
    added = [c for c in split.columns if c not in known.columns]
    both = known.filter(M.is_played() & F.col("over_odd").isNotNull()).join(split.select("event_id", *added), "event_id")
    x = FT.assemble(both, used, {league: (name,) for league, name in of_league.items()}, carry=[c for c in split.columns if c != "event_id"])
    return x.select(*split.columns, F.transform("values", lambda v: F.coalesce(v, F.lit(0.0))).alias("x"), F.col("label_over").alias("y")).transform(stored, "models")


def k_best(train: DataFrame, keys: list[str], k: int = K_BEST) -> DataFrame:
    """``(*keys, scores, chosen)``: ANOVA F per feature of ``x``, and the places of the k highest in rising order (ties to the
    first; a feature without F comes last). Class counts, sums and squares are partial sums."""
    per = (train.select(*keys, "y", F.posexplode("x").alias("at", "v")).groupBy(*keys, "at", "y")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")))
    g = per.groupBy(*keys, "at").agg(F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("q").alias("Q"), F.count(F.lit(1)).alias("C"),
                                     F.sum(F.col("s") * F.col("s") / F.col("n")).alias("cls"))
    between, within = F.col("cls") - F.col("S") * F.col("S") / F.col("N"), F.col("Q") - F.col("cls")
    # a sum of squares that is rounding only (a constant feature, or one that the classes explain) has no F
    none = within <= 1e-12 * F.col("Q")
    f = F.when(~none, div(div(between, F.col("C") - 1), div(within, F.col("N") - F.col("C"))))
    listed = F.sort_array(F.collect_list(F.struct("at", f.alias("f"))))
    one = g.groupBy(*keys).agg(listed.alias("listed"))
    ranked = F.array_sort(F.transform("listed", lambda s: F.struct(F.coalesce(-s["f"], F.lit(float("inf"))).alias("f"), s["at"].alias("at"))))
    return one.select(*keys, F.transform("listed", lambda s: s["f"]).alias("scores"),
                      F.array_sort(F.transform(F.slice(ranked, 1, k), lambda s: s["at"])).alias("chosen"))


def keep_chosen(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(chosen.select(*keys, "chosen"), keys).withColumn(
        "x", F.transform("chosen", lambda i: F.get(F.col("x"), i))).drop("chosen")


def scaler(train: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, mean, scale)``: per feature of ``x``, with the population deviation."""
    per = (train.select(*keys, F.posexplode("x").alias("at", "v")).groupBy(*keys, "at")
           .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")))
    listed = F.sort_array(F.collect_list(F.struct("at", "m", "s")))
    return per.groupBy(*keys).agg(listed.alias("l")).select(
        *keys, F.transform("l", lambda s: s["m"]).alias("mean"), F.transform("l", lambda s: s["s"]).alias("scale"))


def standardised(rows: DataFrame, scale: DataFrame, keys: list[str]) -> DataFrame:
    """Column ``z``: ``x`` centred and scaled; a feature without spread is 0."""
    z = F.zip_with("x", F.arrays_zip("mean", "scale"), lambda v, s: F.coalesce(div(v - s["mean"], s["scale"]), F.lit(0.0)))
    return rows.join(scale, keys).withColumn("z", z).drop("mean", "scale")


# ---------------------------------------------------------------------------
# Logistic regression on arrays: every candidate of a group in one pass
# ---------------------------------------------------------------------------

_CANDIDATE = {"candidate": pa.int32(), "fold": pa.int32(), "c": pa.float64(), "beta": pa.list_(pa.float64()), "n": pa.float64(), "failed": pa.bool_(),
              "step": pa.float64()}
CANDIDATE = "candidate int, fold int, c double, beta array<double>, n double, failed boolean, step double"


def _sums(keys: list[str]):
    """Per group and candidate: number of rows, gradient and upper half of the Hessian, packed in one array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            asked, held = None, []
            for block in group:
                if asked is None:
                    asked = block.value("candidates")
                    betas = [np.asarray(c["beta"], dtype=float) for c in asked]
                    held = [0.0] * len(asked)
                x = np.concatenate([np.ones((1, block.value("n"))), block.matrix("z")])
                y, fold = block.array("y").astype(float), block.array("fold")
                upper = np.triu_indices(len(x))
                part = {f: (x, y) if f == T.ALL else (np.ascontiguousarray(x[:, fold != f]), y[fold != f]) for f in {c["fold"] for c in asked}}
                for i, c in enumerate(asked):
                    xs, ys = part[c["fold"]]
                    p = 1 / (1 + np.exp(-np.clip(betas[i] @ xs, -ETA, ETA)))
                    held[i] = held[i] + np.concatenate([[len(ys)], xs @ (p - ys), ((xs * (p * (1 - p))) @ xs.T)[upper]])
            types = block.types(keys) | {k: _CANDIDATE[k] for k in ("candidate", "fold", "c", "beta")} | {"sums": pa.list_(pa.float64())}
            yield B.batch_of(types, [(*key, c["candidate"], c["fold"], c["c"], c["beta"], v.tolist()) for c, v in zip(asked, held)])
    return run


def _newton(keys: list[str], ridge: float):
    """The step of a candidate from the sums of all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, types = [], None
        for key, group in B.by_group(batches, [*keys, "candidate"]):
            sums = 0.0
            for row in group:
                sums = sums + np.asarray(row.value("sums"))
            types = types or row.types(keys) | _CANDIDATE
            beta, c = np.asarray(row.value("beta")), row.value("c")
            m = len(beta)
            hess = np.zeros((m, m))
            hess[np.triu_indices(m)] = sums[1 + m:]
            hess = hess + np.triu(hess, 1).T
            pen = np.full(m, 1.0 / c)
            pen[0] = ridge
            try:
                step = np.linalg.solve(hess + np.diag(pen), sums[1:1 + m] + pen * beta)
            except np.linalg.LinAlgError:
                step = np.full(m, np.nan)
            bad = not np.isfinite(step).all()
            out.append((*key, row.value("fold"), c, (beta if bad else beta - step).tolist(), float(sums[0]), bad, 0.0 if bad else float(np.abs(step).max())))
        if out:
            yield B.batch_of(types, out)
    return run


def fit_logistic_arrays(blocks: DataFrame, keys: list[str], candidates: list[tuple[int, float]], max_iter: int = 20, tol: float = 1e-8) -> DataFrame:
    """``(*keys, candidate, fold, c, beta, n, failed, step)``: L2-regularised logistic regression (intercept free) of every group and
    candidate (held-out fold or -1, C). ``blocks``: of rows with ``z``, ``y``, ``fold``.

    A Newton step reads each block once for all candidates of its group: tasks sum the packed Hessians of the groups they meet, the
    sums of all tasks are added and the small systems solved where they meet. Candidates whose step is under
    ``tol`` are not read again; only whether one is open reaches the driver."""
    key_schema = B.key_schema(blocks, keys)
    grid = F.array(*[F.struct(F.lit(i).alias("candidate"), F.lit(f).alias("fold"), F.lit(c).alias("c")) for i, (f, c) in enumerate(candidates)])
    state = (blocks.groupBy(*keys).agg(F.max("d").alias("d")).select(*keys, "d", F.inline(grid))
             .select(*keys, "candidate", "fold", "c", F.array_repeat(F.lit(0.0), F.col("d") + 1).alias("beta")).transform(stored, "models"))
    closed = None
    for _ in range(max_iter):
        # a row per group, its candidates: broadcast
        asked = state.groupBy(*keys).agg(F.collect_list(F.struct("candidate", "fold", "c", "beta")).alias("candidates"))
        partial = (blocks.select(*keys, "n", "d", "y", "fold", "z").join(F.broadcast(asked), keys)
                   .mapInArrow(_sums(keys), f"{key_schema}, candidate int, fold int, c double, beta array<double>, sums array<double>"))
        moved = B.brought_together(partial, [*keys, "candidate"]).mapInArrow(_newton(keys, L.INTERCEPT_RIDGE), f"{key_schema}, {CANDIDATE}").transform(stored, "models")
        still = (F.col("step") >= tol) & ~F.col("failed")
        finished = moved.filter(~still)
        closed = finished if closed is None else closed.unionByName(finished)
        state = moved.filter(still)
        if state.isEmpty():
            return closed
    return closed.unionByName(state.withColumn("failed", F.lit(True)))


def linear_probability(beta: Column, z: Column) -> Column:
    eta = F.aggregate(F.zip_with(F.slice(beta, 2, F.size(beta) - 1), z, lambda b, v: b * v), F.get(beta, F.lit(0)), lambda a, v: a + v)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(eta, F.lit(-ETA)), F.lit(ETA))))


# ---------------------------------------------------------------------------
# Candidates, choice, registry
# ---------------------------------------------------------------------------

def _held_statistics(trees: int, seed: int):
    """Class statistics of ``trees`` trees per held-out fold (-1: none), without a copy of the rows: a row has no weight in the
    trees that hold its fold out."""
    def stat(block: B.Block):
        y, fold, event = block.array("y").astype(np.int64), block.array("fold"), block.array("event_id")
        drawn = [T.weights(event, t, seed) for t in range(trees)]

        def of(i: int):
            w = np.where(fold == i // trees - 1, 0, drawn[i % trees])
            return w * y, w
        return of
    return stat


def fit_forests(packed: DataFrame, keys: list[str], folds: int = FOLDS, trees: int = 8, depth: int = 3, seed: int = 0) -> DataFrame:
    """``(*keys, fold, trees)``: a forest on all rows (fold -1) and one without each fold, grown together. ``packed``: blocks of rows with
    ``event_id``, ``x``, ``y``, ``fold``."""
    cut = T.edges_of(packed, keys).transform(stored, "models")
    blocks = T.binned(packed, cut, keys, ["event_id", "y", "fold"])
    nodes = T.grow_blocks(blocks, keys, trees * (folds + 1), depth, _held_statistics(trees, seed), min_rows=2, share=T.root_share, seed=seed)
    # the fold is a part of the key from here on: a tree without rows is missing in its own fold only
    named = nodes.withColumn("fold", (F.floor(F.col("tree") / trees) - 1).cast("int"))
    every = cut.drop("fit").withColumn("fold", F.explode(F.sequence(F.lit(-1), F.lit(folds - 1))))
    return T.assemble(named, every, [*keys, "fold"], depth)


def fit_boosted(packed: DataFrame, keys: list[str], folds: int = FOLDS, stages: int = 10, depth: int = 2, rate: float = 0.3, ridge: float = 1.0,
                min_rows: int = 2, tol: float = 1e-3) -> DataFrame:
    """``(*keys, fold, trees, base, rate)``: boosting on all rows (fold -1) and without each fold; the fold is a
    part of the group key, since every fold has its own edges and margins. Only the rows' bins are there once per fold."""
    fits = list(range(-1, folds))
    cut = T.edges_of(packed, keys, folds=True, fits=fits).transform(stored, "models")
    blocks = T.binned(packed, cut, keys, ["y", "fold"], fits).drop("fold").withColumnRenamed("fit", "fold")
    base = packed.mapInArrow(_class_counts(keys), f"{B.key_schema(packed, keys)}, fold int, y long, n long")
    share = F.sum("y").cast("double") / F.sum("n").cast("double")
    base = (base.select(*keys, F.col("fold").alias("own"), "y", "n", F.explode(F.lit(fits)).alias("fold")).filter("own <> fold")
            .groupBy(*keys, "fold").agg(T.log_odds(share).alias("base")).transform(stored, "models"))
    return T.boost_blocks(blocks, base, cut.withColumnRenamed("fit", "fold"), [*keys, "fold"], stages, depth, rate, ridge, min_rows, tol)[0]


def _class_counts(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.each(batches, keys):
            y, fold = block.array("y"), block.array("fold")
            types = block.types(keys) | {"fold": pa.int32(), "y": pa.int64(), "n": pa.int64()}
            yield B.batch_of(types, [(*block.key, int(f), int(y[fold == f].sum()), int((fold == f).sum())) for f in np.unique(fold)])
    return run


def candidates(spark: SparkSession, train: DataFrame, keys: list[str] = KEYS) -> dict[str, DataFrame]:
    """Fitted models of every family, fold -1 (all train rows) to ``FOLDS`` - 1 (that fold held out). ``train``: keys, event_id,
    ``x``, ``z``, ``y``, ``fold``."""
    grid = [(f, c) for c in C_GRID for f in range(-1, FOLDS)]
    packed = B.pack(train, keys, ["event_id", "y", "fold"], ["x", "z"])
    return {"logistic": fit_logistic_arrays(packed, keys, grid).transform(stored, "models"),
            "forest": fit_forests(packed, keys, FOLDS, **FOREST).transform(stored, "models"),
            "boosted": fit_boosted(packed, keys, FOLDS, **BOOST).transform(stored, "models")}


def _probability(family: str) -> Column:
    if family == "logistic":
        return linear_probability(F.col("beta"), F.col("z"))
    if family == "forest":
        return T.forest_probability(F.col("trees"), F.col("x"))
    return T.boosted_probability(F.col("trees"), F.col("base"), F.col("rate"), F.col("x"))


def _parameters(family: str) -> Column:
    if family == "logistic":
        return F.concat(F.lit("C="), F.col("c").cast("string"))
    how = FOREST if family == "forest" else BOOST
    return F.lit(", ".join(f"{k}={v}" for k, v in how.items()))


def cv_table(train: DataFrame, models: dict[str, DataFrame], keys: list[str] = KEYS) -> DataFrame:
    """``(*keys, family, parameters, n_correct, n, cv_accuracy)``: each row scored by the model that held its fold out."""
    parts = []
    for family, fitted in models.items():
        held = train.join(fitted.filter("fold >= 0"), [*keys, "fold"]).withColumn("parameters", _parameters(family))
        right = ((_probability(family) >= 0.5).cast("int") == F.col("y")).cast("long")
        parts.append(held.groupBy(*keys, "parameters").agg(F.sum(right).alias("n_correct"), F.count(F.lit(1)).alias("n"))
                     .select(*keys, F.lit(family).alias("family"), "parameters", "n_correct", "n", div("n_correct", "n").alias("cv_accuracy")))
    return reduce(DataFrame.unionByName, parts)


def best_candidate(table: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The table with ``is_best``: most correct held-out rows; ties go to the simpler family (logistic, forest, boosted), then to
    the parameters of smaller text."""
    order = F.when(F.col("family") == "logistic", 0).when(F.col("family") == "forest", 1).otherwise(2)
    w = Window.partitionBy(*keys).orderBy(F.col("n_correct").desc(), order, "parameters")
    return table.withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))


def registry(models: dict[str, DataFrame], chosen: DataFrame, names: DataFrame, scale: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per group: the chosen candidate fitted on all train rows, in the one schema of all families (``REGISTRY``)."""
    best = chosen.filter("is_best = 1").select(*keys, "family", "parameters", "cv_accuracy")
    none_d, none_t = F.lit(None).cast("double"), F.lit(None).cast(f"array<{T.TREE}>")
    empty = F.lit(None).cast("array<double>")
    parts = []
    for family, fitted in models.items():
        linear = family == "logistic"
        boosted = family == "boosted"
        parts.append(fitted.filter("fold = -1").withColumn("family", F.lit(family)).withColumn("parameters", _parameters(family))
                     .select(*keys, "family", "parameters",
                             (F.slice("beta", 2, F.size("beta") - 1) if linear else empty).alias("coef"),
                             (F.get("beta", F.lit(0)) if linear else none_d).alias("intercept"),
                             (none_t if linear else F.col("trees")).alias("trees"),
                             (F.col("base") if boosted else none_d).alias("base"), (F.col("rate") if boosted else none_d).alias("rate")))
    fitted = reduce(DataFrame.unionByName, parts)
    return best.join(fitted, [*keys, "family", "parameters"]).join(names, keys).join(scale, keys)


def score(x: Column | str = "x") -> Column:
    """Probability of OVER from a registry row beside ``x`` (the model's own features, missing values filled)."""
    x = F.col(x) if isinstance(x, str) else x
    z = F.zip_with(x, F.arrays_zip("mean", "scale"), lambda v, s: F.coalesce(div(v - s["mean"], s["scale"]), F.lit(0.0)))
    beta = F.concat(F.array("intercept"), F.col("coef"))
    return (F.when(F.col("coef").isNotNull(), linear_probability(beta, z))
            .when(F.col("base").isNotNull(), T.boosted_probability(F.col("trees"), F.col("base"), F.col("rate"), x))
            .otherwise(T.forest_probability(F.col("trees"), x)))


def features_of(row_features: Column, names: Column, missing: float = 0.0) -> Column:
    """The model's features in its order from a map; absent or null ones take ``missing``."""
    return F.transform(names, lambda n: F.coalesce(F.try_element_at(row_features, n), F.lit(missing)))


def prepared(spark: SparkSession, rows: DataFrame, keys: list[str] = KEYS, k: int = K_BEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train rows ready to fit (chosen features, standardised, folds), the chosen features, and the scaler."""
    train = rows.filter("is_train = 1")
    chosen = k_best(train, keys, k).transform(stored, "models")
    kept = keep_chosen(train.select(*keys, "event_id", "start_time", "label_over", "x", "y"), chosen, keys)
    scale = scaler(kept, keys).transform(stored, "models")
    folds = L.cv_folds(train, FOLDS).select("event_id", "fold")
    ready = standardised(kept, scale, keys).join(folds, "event_id").select(*keys, "event_id", "x", "z", "y", "fold").transform(stored, "models")
    return ready, chosen, scale


def threshold_table(ready: DataFrame, reg: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    scored = ready.join(reg, keys).select(*keys, "y", score("x").alias("probability")).withColumnRenamed("y", "label_over")
    return L.threshold_search(scored, keys, score="probability").select(*keys, "threshold")


def fit(spark: SparkSession, rows: DataFrame, names: DataFrame, keys: list[str] = KEYS, k: int = K_BEST) -> tuple[DataFrame, DataFrame]:
    """``(registry, cv table)`` of every gated window. ``names``: league -> ``feature_names`` in the vector's order."""
    ready, chosen, scale = prepared(spark, rows, keys, k)
    models = candidates(spark, ready, keys)
    table = best_candidate(cv_table(ready, models, keys), keys).transform(stored, "models")
    cols = (chosen.join(names, keys[0]).select(*keys, F.transform("chosen", lambda i: F.get(F.col("feature_names"), i)).alias("feature_cols")))
    reg = registry(models, table, cols, scale, keys).transform(stored, "models")
    labels = rows.select(*keys, "window_label").distinct()
    n = ready.groupBy(*keys).agg(F.count(F.lit(1)).alias("trained_n"))
    reg = reg.join(threshold_table(ready, reg, keys), keys).join(labels, keys).join(n, keys)
    return reg.select(*keys, "window_label", F.col("family").alias("model_name"), "parameters", "cv_accuracy", "feature_cols", "mean", "scale",
                      "coef", "intercept", "trees", "base", "rate", "threshold", "trained_n"), table

