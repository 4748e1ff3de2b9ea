"""Labels, split sizes, threshold ties, grouped logistic fit against pyspark.ml."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.operators import evaluate as EV
from oddsframe.operators import learn as L


def test_label_edge_total_equal_cap_is_under(spark):
    df = spark.createDataFrame([(1, 1, 2.5), (2, 1, 2.5), (2, 2, 3.5), (1, 2, 3.0), (None, 1, 2.5)],
                               "home_ft_score int, away_ft_score int, over_under_cap double")
    got = [r[0] for r in df.select(L.label_over()).collect()]
    assert got == [0, 1, 1, 0, None]


def test_split_sizes_follow_floor_rule(spark):
    # published (n, train) pairs: train = floor(0.7 n), integer arithmetic
    pairs = [(99, 69), (137, 95), (72, 50), (104, 72), (67, 46), (8, 5), (22, 15), (90, 63), (170, 119), (180, 126)]
    rows = []
    eid = 0
    for w, (n, _train) in enumerate(pairs):
        for i in range(n):
            eid += 1
            rows.append((eid, 1, 2000, w, dt.datetime(2000, 1, 1) + dt.timedelta(hours=i), 1))
    df = spark.createDataFrame(rows, "event_id long, event_type_id int, season_start int, window_no int, "
                                     "start_time timestamp_ntz, label_over int")
    got = {r.window_no: r.n for r in L.chrono_split(df).filter("is_train = 1").groupBy("window_no")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {w: t for w, (_n, t) in enumerate(pairs)}


def test_threshold_tie_takes_lowest(spark):
    # scores 0.40 (y=0) and 0.60 (y=1): every t in (0.40, 0.60] is perfect -> 0.41
    rows = [(1, 0.40, 0), (1, 0.60, 1), (1, 0.40, 0), (1, 0.60, 1), (1, 0.405, 0), (1, 0.6, 1)]
    df = spark.createDataFrame(rows, "g int, p_over_fair double, label_over int")
    r = L.threshold_search(df, ["g"]).collect()[0]
    assert abs(r.threshold - 0.41) < 1e-12 and r.n_correct_train == 6


def test_threshold_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), float(p), int(y)) for g, p, y in
            zip(rng.integers(0, 3, 300), rng.uniform(0.2, 0.8, 300).round(3), rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "g int, p_over_fair double, label_over int")
    got = {r.g: (r.threshold, r.n_correct_train) for r in L.threshold_search(df, ["g"]).collect()}
    for g in range(3):
        sub = [(p, y) for gg, p, y in rows if gg == g]
        best = None
        for k in range(config.THRESHOLD_GRID_LO, config.THRESHOLD_GRID_HI + 1):
            t = float(k) / 100.0
            c = sum(1 for p, y in sub if (p >= t) == (y == 1))
            if best is None or c > best[1]:
                best = (t, c)
        assert got[g] == best


def test_grouped_logistic_matches_ml(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(3)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(0.3 + 1.2 * x1 - 0.7 * x2)))).astype(int)
    df = spark.createDataFrame([(1, float(a), float(b), int(c)) for a, b, c in zip(x1, x2, y)],
                               "g int, z_a double, z_b double, label_over int")
    c_reg = 2.0
    ours = L.fit_logistic_groups(spark, df, ["g"], ["a", "b"], c_reg=c_reg).collect()[0]
    assert ours.converged
    vec = VectorAssembler(inputCols=["z_a", "z_b"], outputCol="features").transform(df)
    ml = LogisticRegression(labelCol="label_over", regParam=1.0 / (c_reg * n), elasticNetParam=0.0,
                            standardization=False, tol=1e-12, maxIter=200).fit(vec)
    assert abs(ours.intercept - ml.intercept) < 1e-4
    assert np.allclose(ours.coef, ml.coefficients.toArray(), atol=1e-4)


def test_roi_settlement(spark):
    rows = [(1, 1, 2.10, 1.80), (1, 0, 2.10, 1.80), (0, 0, 1.95, 1.85), (0, 1, 1.95, 1.85)]
    df = spark.createDataFrame(rows, "pred_over int, label_over int, over_odd double, under_odd double")
    s = EV.settle(df).collect()
    assert [r.pnl for r in s] == [110, -100, 85, -100]
    roi = EV.betting_roi(EV.settle(df).withColumn("k", F.lit(1)), ["k"]).collect()[0]
    assert roi.pnl == -5 and abs(roi.roi_pct - (-1.25)) < 1e-12


def test_leakage_guard():
    import pytest
    with pytest.raises(ValueError):
        L.assert_no_leakage(["p_over_fair", "home_ft_score"])


def test_one_class_group_stays_finite(spark):
    rows = [(1, float(i % 5) - 2.0, float(i % 3) - 1.0, 1) for i in range(12)]
    rows += [(2, float(i % 5) - 2.0, float(i % 3) - 1.0, i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "g int, z_a double, z_b double, label_over int")
    got = {r.g: r for r in L.fit_logistic_groups(spark, df, ["g"], ["a", "b"]).collect()}
    assert np.isfinite(got[1].intercept) and got[1].intercept > 5
    assert all(np.isfinite(c) for r in got.values() for c in r.coef)


def test_grid_of_held_out_folds_equals_copied_rows(spark):
    """One fit per (C, held-out fold) on rows kept once is the fit on a copy of the rows for each; no step shuffles rows."""
    rng = np.random.default_rng(3)
    rows = [(int(i % 2), int(i % 3), float(a), float(b), int(a + rng.normal() > 0)) for i, (a, b) in enumerate(rng.normal(size=(240, 2)))]
    df = spark.createDataFrame(rows, "g int, fold int, z_a double, z_b double, label_over int")
    grid = F.array(*[F.struct(F.lit(c).alias("c_reg"), F.lit(f).alias("cv_fold")) for c in (0.1, 1.0) for f in (-1, 0, 1, 2)])
    copies = df.select("*", F.inline(grid)).filter("cv_fold <> fold")
    keys = ["g", "c_reg", "cv_fold"]
    want = {tuple(r[k] for k in keys): r for r in L.fit_logistic_groups(spark, copies, keys, ["a", "b"], c_col="c_reg").collect()}
    got = L.fit_logistic_groups(spark, df, ["g"], ["a", "b"], c_col="c_reg", grid=grid, held_out=("fold", "cv_fold")).collect()
    assert len(got) == len(want) == 16
    for r in got:
        w = want[tuple(r[k] for k in keys)]
        assert r.converged and r.trained_n == w.trained_n and np.allclose([r.intercept, *r.coef], [w.intercept, *w.coef], atol=1e-9)
