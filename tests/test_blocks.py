"""Blocks of rows, the hashes that numpy and Spark share, and passes that send sums instead of rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsframe.operators import blocks as B
from oddsframe.operators import models as MD
from oddsframe.operators import trees as T


def test_blocks_hold_every_row_once(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abc"), i, i % 2, [float(i), None, -1.5]) for i in range(700)] + [(None, 9999, 1, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "grp string, event_id long, y int, x array<double>").repartition(5)
    got = {}
    for r in B.pack(df, ["grp"], ["event_id", "y"], ["x"]).collect():
        event, y = np.frombuffer(r.event_id, "<i8"), np.frombuffer(r.y, "i1")
        x = np.frombuffer(r.x, "<f8").reshape(r.d, r.n).T
        got |= {int(e): (r.grp, int(label), v.tolist()) for e, label, v in zip(event, y, x)}
    assert got == {i: (g, y, [x[0], -np.inf, x[2]]) for g, i, y, x in rows if g is not None}
    with pytest.raises(Exception, match="differ in length"):
        B.pack(df.withColumn("x", F.slice("x", 1, F.when(F.col("event_id") < 350, 2).otherwise(3))), ["grp"], ["y"], ["x"])


def test_hashes_are_sparks(spark):
    ids = [0, 1, -1, 2**40 + 7, -(2**61), 149999, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "event_id long")
    for tree, seed in ((0, 0), (3, 9), (47, -5)):
        want = [r.w for r in df.select(T.bootstrap_weight(F.lit(tree), seed=seed).alias("w")).collect()]
        assert T.weights(np.array(ids), tree, seed).tolist() == want
    for tree, node, d, count in ((0, 0, 31, 6), (5, 3, 20, 5), (19, 14, 4, 4)):
        want = spark.range(1).select(T.offered(F.lit(tree), F.lit(node), F.lit(d), F.lit(count), 3).alias("f")).first().f
        assert T.may_use(tree, node, d, count, 3).tolist() == sorted(want)


def test_quantiles_of_a_large_group_are_close_and_those_of_few_values_exact(spark):
    n = 30000   # more than ACCURACY
    df = spark.range(n).select(F.lit(1).alias("grp"), F.col("id").alias("event_id"), F.lit(0).alias("y"),
                               F.array((F.col("id") * 7919 % n).cast("double"), (F.col("id") % 40).cast("double")).alias("x")).repartition(6)
    smooth, few = T.edges(df, ["grp"]).first().edges
    assert len(smooth) == T.BINS - 1 and all(abs(v + 1 - n * i / T.BINS) <= n / T.ACCURACY + 1 for i, v in enumerate(smooth, 1))
    assert few == sorted({float(-(-n * i // T.BINS) - 1) // (n // 40) for i in range(1, T.BINS)})


def test_no_pass_sends_rows(spark, monkeypatch):
    """A level's shuffle holds a table of counts per task, group and tree. Before, every row went through an explode by tree and
    by feature."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, label)
    stored = T.stored
    monkeypatch.setattr(T, "stored", seen)
    rows = spark.range(400).select((F.col("id") % 2).cast("int").alias("grp"), F.col("id").alias("event_id"), (F.col("id") % 3 > 0).cast("int").alias("y"),
                                   F.array((F.col("id") % 11).cast("double"), (F.col("id") % 7).cast("double")).alias("x"))
    T.fit_forest_groups(rows, ["grp"], 6, 2).collect()
    T.fit_boosted_groups(spark, rows, ["grp"], stages=2)
    assert plans and not any("posexplode" in p for p in plans)


def test_a_tree_without_rows_is_missing_in_its_own_fold_only(spark):
    """In a group of few rows a bootstrap sample may be empty. Trees were cut into folds by their place in the list, so such a
    tree moved trees that had seen a fold's rows into the forest that holds them out."""
    trees = 8
    weight = {(e, t): int(T.weights(np.array([e]), t)[0]) for e in range(400) for t in range(trees)}
    # five rows, one of each fold, and a tree whose sample is empty without fold 0
    first = next(e for e in range(0, 400, 5) if any(not sum(weight[e + f, t] for f in range(1, 5)) for t in range(trees)))
    rows = spark.createDataFrame([(1, first + f, f % 2, f, [float(f), 1.0]) for f in range(5)], "grp int, event_id long, y int, fold int, x array<double>")
    packed = B.pack(rows, ["grp"], ["event_id", "y", "fold"], ["x"])
    got = {r.fold: r.trees for r in MD.fit_forests(packed, ["grp"], 5, trees, 1).collect()}
    for fold in range(-1, 5):
        mine = [sum(weight[first + f, t] for f in range(5) if f != fold) for t in range(trees)]
        share = [sum(weight[first + f, t] * (f % 2) for f in range(5) if f != fold) / n for t, n in enumerate(mine) if n]
        assert [t["value"][0] for t in got[fold]] == pytest.approx(share)
    assert min(len(t) for t in got.values()) < trees
