"""Models of several families per window: feature choice, fits, cross-validated choice, registry and scoring."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsframe.operators import models as MD
from oddsframe.sources.registry import MODEL_SCHEMA, read_registry, write_registry

ROWS = ("event_type_id int, season_start int, window_no int, window_label string, event_id long, start_time timestamp_ntz, "
        "is_train int, label_over int, y int, x array<double>")
D, K = 8, 4


def _rows():
    rnd = random.Random(11)
    out = []
    for i in range(240):
        league = 1 + i % 2
        x = [rnd.gauss(0, 1) for _ in range(D - 2)] + [3.0, float(i % 5)]
        y = int((x[1] - x[4] if league == 1 else abs(x[2]) - 0.7) + rnd.gauss(0, 0.3) > 0)
        out.append((league, 2000, 1, "2000-W1", i, dt.datetime(2000, 1, 1) + dt.timedelta(hours=i), int(i < 180), y, y, x))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    names = spark.createDataFrame([(g, [f"f{g}_{j}" for j in range(D)]) for g in (1, 2)], "event_type_id int, feature_names array<string>")
    old = MD.FOREST, MD.BOOST, MD.C_GRID
    MD.FOREST, MD.BOOST, MD.C_GRID = {"trees": 4, "depth": 2}, {"stages": 2, "depth": 2, "rate": 0.5}, (0.1, 1.0)
    try:
        ready, chosen, scale = MD.prepared(spark, df, k=K)
        models = MD.candidates(spark, ready)
        table = MD.best_candidate(MD.cv_table(ready, models))
        cols = chosen.join(names, "event_type_id").select(*MD.KEYS, F.transform("chosen", lambda i: F.get("feature_names", i)).alias("feature_cols"))
        reg = MD.registry(models, table, cols, scale)
        return {"rows": rows, "df": df, "ready": ready.collect(), "chosen": chosen.collect(), "models": {k: v.collect() for k, v in models.items()},
                "table": table.collect(), "reg": reg, "thresholds": MD.threshold_table(ready, reg), "parameters": (MD.FOREST, MD.BOOST)}
    finally:
        MD.FOREST, MD.BOOST, MD.C_GRID = old


def _anova(x, y):
    groups = [x[y == c] for c in np.unique(y)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - len(groups))
    return None if within < 1e-12 else between / within


def test_k_best_equals_brute_force_on_train_rows(fitted):
    for r in fitted["chosen"]:
        mine = [t for t in fitted["rows"] if t[0] == r.event_type_id and t[6] == 1]
        x, y = np.array([t[9] for t in mine]), np.array([t[8] for t in mine])
        scores = [_anova(x[:, j], y) for j in range(D)]
        for got, want in zip(r.scores, scores):
            assert (got is None) == (want is None) and (want is None or math.isclose(got, want, rel_tol=1e-8))
        best = sorted(range(D), key=lambda j: (-(scores[j] if scores[j] is not None else -math.inf), j))[:K]
        assert list(r.chosen) == sorted(best)


def test_logistic_candidates_have_no_gradient(fitted):
    assert len(fitted["models"]["logistic"]) == 2 * 2 * (MD.FOLDS + 1)
    for m in fitted["models"]["logistic"]:
        mine = [r for r in fitted["ready"] if r.event_type_id == m.event_type_id and r.fold != m.fold]
        z = np.column_stack([np.ones(len(mine)), np.array([r.z for r in mine])])
        y, beta = np.array([r.y for r in mine]), np.array(m.beta)
        grad = z.T @ (1 / (1 + np.exp(-z @ beta)) - y) + np.concatenate([[0.0], beta[1:] / m.c])
        assert not m.failed and m.n == len(mine) and np.abs(grad).max() < 1e-4


def _walk(tree, x):
    n = 0
    while tree["feature"][n] >= 0:
        n = 2 * n + 1 + (x[tree["feature"][n]] > tree["threshold"][n])
    return tree["value"][n]


def _p(family, m, r):
    if family == "logistic":
        return 1 / (1 + math.exp(-(m.beta[0] + sum(b * v for b, v in zip(m.beta[1:], r.z)))))
    leaves = [_walk(t, r.x) for t in m.trees]
    return sum(leaves) / len(leaves) if family == "forest" else 1 / (1 + math.exp(-(m.base + m.rate * sum(leaves))))


def test_choice_equals_brute_force_over_held_out_folds(fitted):
    want = {}
    for family, models in fitted["models"].items():
        for m in models:
            if m.fold < 0:
                continue
            key = (m.event_type_id, family, f"C={m.c}" if family == "logistic" else ", ".join(
                f"{k}={v}" for k, v in fitted["parameters"][family != "forest"].items()))
            held = [r for r in fitted["ready"] if r.event_type_id == m.event_type_id and r.fold == m.fold]
            right, n = want.get(key, (0, 0))
            want[key] = right + sum((_p(family, m, r) >= 0.5) == (r.y == 1) for r in held), n + len(held)
    assert {(r.event_type_id, r.family, r.parameters): (r.n_correct, r.n) for r in fitted["table"]} == want
    rank = {"logistic": 0, "forest": 1, "boosted": 2}
    for g in (1, 2):
        best = min((-v[0], rank[k[1]], k[2], k) for k, v in want.items() if k[0] == g)[3]
        assert [(r.event_type_id, r.family, r.parameters) for r in fitted["table"] if r.event_type_id == g and r.is_best] == [best]
        assert all(n == sum(r.event_type_id == g for r in fitted["ready"]) for k, (_, n) in want.items() if k[0] == g)
    # the second league's label is no linear function of its features
    assert next(r.family for r in fitted["table"] if r.event_type_id == 2 and r.is_best) != "logistic"


def test_registry_round_trip_and_scores_of_every_family(spark, fitted, tmp_path):
    thresholds = fitted["thresholds"]
    full = (fitted["reg"].join(thresholds, MD.KEYS).withColumnRenamed("family", "model_name").withColumn("window_label", F.lit("w"))
            .withColumn("trained_n", F.lit(1).cast("long")))
    reg = read_registry(spark, write_registry(full, str(tmp_path / "reg"), MODEL_SCHEMA), MODEL_SCHEMA)
    rows = {r.event_type_id: r for r in reg.collect()}
    names = {g: [f"f{g}_{j}" for j in range(D)] for g in (1, 2)}
    assert all(len(r.feature_cols) == K and set(r.feature_cols) <= set(names[g]) for g, r in rows.items())
    assert all((r.coef is None) != (r.trees is None) for r in rows.values())
    asked = spark.createDataFrame([(t[0], t[4], dict(zip(names[t[0]], t[9]))) for t in fitted["rows"]], "event_type_id int, event_id long, features map<string,double>")
    got = {r.event_id: r.p for r in asked.join(reg, "event_type_id").select(
        "event_id", MD.score(MD.features_of(F.col("features"), F.col("feature_cols"))).alias("p")).collect()}
    ready = {r.event_id: r for r in fitted["ready"]}
    for g, r in rows.items():
        family = r.model_name
        m = next(m for m in fitted["models"][family] if m.event_type_id == g and m.fold == -1
                 and (family != "logistic" or f"C={m.c}" == r.parameters))
        mine = [e for e in ready.values() if e.event_type_id == g]
        assert all(math.isclose(got[e.event_id], _p(family, m, e), rel_tol=1e-9) for e in mine)
        right = lambda t: sum((got[e.event_id] >= t) == (e.y == 1) for e in mine)
        assert max((right(k / 100), -k) for k in range(30, 71)) == (right(r.threshold), -round(r.threshold * 100))


def test_test_rows_are_never_read(spark, fitted):
    other = fitted["df"].withColumn("y", F.when(F.col("is_train") == 0, 1 - F.col("y")).otherwise(F.col("y"))).withColumn(
        "x", F.when(F.col("is_train") == 0, F.transform("x", lambda v: v * 100)).otherwise(F.col("x")))
    ready, chosen, _scale = MD.prepared(spark, other, k=K)
    same = lambda rows: sorted((r.event_id, r.fold, r.y, r.x, [round(v, 9) for v in r.z]) for r in rows)
    assert same(ready.collect()) == same(fitted["ready"])
    assert sorted((r.event_type_id, r.chosen) for r in chosen.collect()) == sorted((r.event_type_id, r.chosen) for r in fitted["chosen"])


def test_given_matches_are_not_read_again(spark):
    """The split and the league gate of vector rows start from the written matches; both give what the tables give."""
    from oddsframe.operators import learn as L
    from oddsframe.operators import matches as M
    from oddsframe.session import stored
    from oddsframe.sources.tables import fixture_tables
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    m = M.match_frame(t, quote_policy="asof").transform(stored, "test")
    frame = L.train_frame(spark, t, matches=m)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "Aggregate" not in plan
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, L.train_frame(spark, t).collect()))
    assert sorted(map(tuple, L.league_sizes(t, m).collect())) == sorted(map(tuple, L.league_sizes(t).collect()))
