"""Grouped trees against a tree grown by hand on each group."""

import math
import random

import pytest
from pyspark.sql import functions as F

from oddsframe.operators import trees as T

ROWS = "grp string, event_id long, y int, x array<double>"


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    out = []
    for i in range(260):
        grp = "a" if i < 150 else ("b" if i < 240 else "c")
        x = [rnd.randint(0, 6) / 2, rnd.random(), 1.0, float(i % 3)][: 4 if grp == "a" else 3]
        y = int(x[0] + rnd.random() > 2) if grp != "c" else 1
        out.append((grp, i, y, x))
    return out


def _by_group(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


def _cuts(rows):
    """Distinct quantiles i / BINS of each feature: the least value with at least that share at or below it."""
    out = []
    for f in range(len(rows[0][3])):
        v = sorted(r[3][f] for r in rows)
        out.append(sorted({v[max(math.ceil(len(v) * i / T.BINS) - 1, 0)] for i in range(1, T.BINS)}))
    return out


def _tree(rows, stat, depth, ridge, min_rows, allowed, cuts, node=0, level=0):
    """{node: (feature, threshold, value)} by trying every edge of every feature."""
    here = [(r, *stat(r)) for r in rows]
    here = [t for t in here if t[2] > 0]
    g, h = sum(t[1] for t in here), sum(t[2] for t in here)
    score = lambda a, b: a * a / (b + ridge)
    best = None
    if level < depth:
        for f in allowed(node, len(rows[0][3])):
            for b, cut in enumerate(cuts[f]):
                left = [t for t in here if t[0][3][f] <= cut]
                if min(len(left), len(here) - len(left)) < min_rows or not any(sum(c < t[0][3][f] for c in cuts[f]) == b for t in here):
                    continue
                gl, hl = sum(t[1] for t in left), sum(t[2] for t in left)
                gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
                if gain > T.MIN_GAIN and (best is None or (gain, -f, -b) > best[0]):
                    best = ((gain, -f, -b), f, cut)
    out = {node: (-1 if best is None else best[1], 0.0 if best is None else best[2], g / (h + ridge))}
    if best is not None:
        for child, side in ((2 * node + 1, True), (2 * node + 2, False)):
            out.update(_tree([t[0] for t in here if (t[0][3][best[1]] <= best[2]) == side], stat, depth, ridge, min_rows, allowed, cuts, child, level + 1))
    return out


def _same(tree, want):
    for i, f in enumerate(tree["feature"]):
        assert (f, tree["threshold"][i], pytest.approx(tree["value"][i], abs=1e-12)) == want.get(i, (-1, 0.0, 0.0))


def test_single_tree_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    cut = T.edges(df, ["grp"])
    assert {r.grp: r.edges for r in cut.collect()} == {g: _cuts(rs) for g, rs in _by_group(rows).items()}
    nodes = T.grow(T.with_bins(df, cut, ["grp"]), ["grp"], 1, 3, T.class_statistics(bagged=False), min_rows=4)
    got = {r.grp: r.trees for r in T.assemble(nodes, cut, ["grp"], 3).collect()}
    for grp, rs in _by_group(rows).items():
        want = _tree(rs, lambda r: (r[2], 1), 3, 0.0, 4, lambda _n, d: range(d), _cuts(rs))
        _same(got[grp][0].asDict(), want)
    assert got["c"][0]["feature"] == [-1] * 15 and got["c"][0]["value"][0] == 1.0   # one class: a leaf


def test_forest_equals_brute_force_and_does_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    fit = lambda d: {r.grp: r.trees for r in T.fit_forest_groups(d, ["grp"], trees=4, depth=2, min_rows=2, seed=9).collect()}
    got = fit(df.repartition(5))
    assert got == fit(df.coalesce(1))
    weight = {(r.event_id, r.t): r.w for r in df.select("event_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("t")).select(
        "event_id", "t", T.bootstrap_weight(F.col("t"), seed=9).alias("w")).collect()}
    assert 0.8 < sum(weight.values()) / len(weight) < 1.2 and max(weight.values()) >= 3
    grid = spark.range(4).select(F.col("id").cast("int").alias("t")).crossJoin(spark.range(7).select(F.col("id").cast("int").alias("n")))
    may = {(r.t, r.n, d): r[f"d{d}"] for d in (3, 4) for r in grid.select(
        "t", "n", T.offered(F.col("t"), F.col("n"), F.lit(d), F.lit(2), 9).alias(f"d{d}")).collect()}
    for grp, rs in _by_group(rows).items():
        for t in range(4):
            want = _tree(rs, lambda r: (r[2] * weight[r[1], t], weight[r[1], t]), 2, 0.0, 2, lambda n, d: sorted(may[t, n, d]), _cuts(rs))
            _same(got[grp][t].asDict(), want)


def test_boosting_loss_falls_and_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    model, losses = T.fit_boosted_groups(spark, df, ["grp"], stages=4, depth=2, rate=0.5, min_rows=3, tol=1e-4)
    got = {r.grp: r for r in model.collect()}
    path = {}
    for r in sorted(losses.collect(), key=lambda r: r.stage):
        path.setdefault(r.grp, []).append(r.loss)
    for grp, rs in _by_group(rows).items():
        assert all(b < a for a, b in zip(path[grp], path[grp][1:])) and len(got[grp].trees) == len(path[grp]) - 1
        share = min(max(sum(r[2] for r in rs) / len(rs), 1e-3), 1 - 1e-3)
        margin = {r[1]: math.log(share / (1 - share)) for r in rs}
        assert got[grp].base == pytest.approx(math.log(share / (1 - share)))
        for tree in got[grp].trees:
            def stat(r):
                p = 1 / (1 + math.exp(-margin[r[1]]))
                return round((r[2] - p) * T.UNIT), max(round(p * (1 - p) * T.UNIT), 1)
            want = _tree(rs, stat, 2, 1.0 * T.UNIT, 3, lambda _n, d: range(d), _cuts(rs))
            _same(tree.asDict(), want)
            for r in rs:
                n = 0
                while want[n][0] >= 0:
                    n = 2 * n + 1 + (r[3][want[n][0]] > want[n][1])
                margin[r[1]] += 0.5 * want[n][2]
    assert len(got["a"].trees) == 4 and len(path["c"]) < 6   # the one-class group closes early or keeps falling


def test_walk_of_literal_trees(spark):
    tree = ([0, 1, -1, -1, -1, -1, -1], [1.5] + [0.0] * 6, [0.0, 0.0, 0.9, 0.1, 0.4, 0.0, 0.0])
    df = spark.createDataFrame([([1.5, -1.0], [tree]), ([1.0, 0.5], [tree]), ([2.0, 0.0], [tree]), ([None, None], [tree]), ([1.0, 1.0], [])],
                               f"x array<double>, trees array<{T.TREE}>")
    got = [r.v for r in df.select(T.leaf_values(F.col("trees"), F.col("x")).alias("v")).collect()]
    assert got == [[0.1], [0.4], [0.9], [0.1], []]


def test_empty_frame(spark):
    none = spark.createDataFrame([], ROWS)
    assert T.fit_forest_groups(none, ["grp"], 2, 2).collect() == []
    model, losses = T.fit_boosted_groups(spark, none, ["grp"], stages=2)
    assert model.collect() == [] and losses.collect() == []
