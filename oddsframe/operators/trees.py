"""Decision trees, forests and boosting for every group of rows at once.

Rows carry an array of features ``x`` and a label ``y``. They are packed into blocks (``operators.blocks``), and per group and feature
the values are cut at quantiles (``edges``); from then on a row is a byte per feature, its bin. A tree level of all groups and trees is one
pass over the blocks: a task walks its rows down the splits found so far, counts them by (tree, node, feature, bin) with numpy, only for the
features that a node may split on, and passes on one table of counts per group and tree. Their sum gives every split's gain and the best
one. Leaves need no pass: their counts are the two sides of the last splits. Rows are never written again; the splits of every level are,
in the shared checkpoint folder.

Statistics of a row are whole numbers (class counts, or gradients in steps of 1 / ``UNIT``), so sums, gains and ties do not
depend on the order of rows or on partitioning. Ties go to the smaller feature and then the smaller edge.

A model is an array of trees per group, a tree three arrays by node number (children of i: 2 i + 1 and 2 i + 2): feature
(-1 at a leaf), threshold (x <= threshold goes left) and value. ``leaf_values`` walks them inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe.operators import blocks as B
from oddsframe.session import stored

BINS = 32                # at most BINS - 1 edges of a feature
ACCURACY = 10000         # of the quantiles: exact for groups of up to that many rows or features of up to that many values
UNIT = 1 << 20           # steps of a gradient
MIN_GAIN = 1e-7
TREE = "struct<feature:array<int>,threshold:array<double>,value:array<double>>"
# Poisson(1) in steps of 2^-20: how often a row is in a bootstrap sample
POISSON = (385749, 771499, 964374, 1028665, 1044738, 1047953, 1048488, 1048565, 1048575)
COUNT_BITS = 14          # a block has under 2^14 rows: their number and the sum of h share one exact double
ALL = -1                 # the fit on all folds


# ---------------------------------------------------------------------------
# Quantiles and bins
# ---------------------------------------------------------------------------

def _weighted(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, rising, with their counts."""
    if not values:
        return np.empty(0), np.empty(0, dtype="<i8")
    v, at = np.unique(np.concatenate(values), return_inverse=True)
    return v, np.bincount(at, weights=np.concatenate(counts), minlength=len(v)).astype("<i8")


def _shortened(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``ACCURACY`` of the values, at even steps of their rank, each with the count of those that it stands for."""
    if len(v) <= ACCURACY:
        return v, c
    upto = np.cumsum(c)
    at = np.unique(np.searchsorted(upto, np.ceil(np.arange(1, ACCURACY + 1) * (upto[-1] / ACCURACY)).clip(max=upto[-1])))
    return v[at], np.diff(upto[at], prepend=0)


def _value_counts(keys: list[str], folds: bool):
    """Per group, feature and fold of a task: the distinct values and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            held: dict[tuple[int, int], tuple[list, list]] = {}
            for block in group:
                x = block.matrix("x")
                of = block.array("fold") if folds else np.full(x.shape[1], ALL)
                for fold in np.unique(of):
                    for at, row in enumerate(x[:, of == fold]):
                        v, c = np.unique(row[row > -np.inf], return_counts=True)
                        values, counts = held.setdefault((at, int(fold)), ([], []))
                        values.append(v)
                        counts.append(c)
                        if len(values) == 64:
                            merged = _weighted(values, counts)
                            held[at, int(fold)] = [merged[0]], [merged[1]]
            types = block.types(keys) | {"at": pa.int32(), "fold": pa.int32(), "v": pa.binary(), "c": pa.binary()}
            rows = [(*key, at, fold, *(a.tobytes() for a in _shortened(*_weighted(*vc)))) for (at, fold), vc in held.items()]
            yield B.batch_of(types, rows)
    return run


def _quantiles(keys: list[str], bins: int, fits: list[int]):
    """Per group, feature and fit: the distinct quantiles of the folds that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, [*keys, "at"]):
            held: dict[int, tuple[list, list]] = {}
            for row in group:
                values, counts = held.setdefault(row.value("fold"), ([], []))
                values.append(np.frombuffer(row.value("v")))
                counts.append(np.frombuffer(row.value("c"), dtype="<i8"))
            out = []
            for fit in fits:
                parts = [vc for fold, vc in held.items() if fit == ALL or fold != fit]
                v, c = _weighted([v for p in parts for v in p[0]], [c for p in parts for c in p[1]])
                upto = np.cumsum(c)
                n = int(upto[-1]) if len(v) else 0
                ranks = [max(-(-n * i // bins), 1) for i in range(1, bins)]
                out.append((*key, fit, np.unique(v[np.searchsorted(upto, ranks)]).tolist() if n else []))
            yield B.batch_of(row.types([*keys, "at"]) | {"fit": pa.int32(), "cut": pa.list_(pa.float64())}, out)
    return run


def edges_of(packed: DataFrame, keys: list[str], folds: bool = False, fits: list[int] | None = None, bins: int = BINS) -> DataFrame:
    """``(*keys, fit, edges)`` of packed rows: per feature its distinct quantiles, rising, for every fit (held-out fold, or ``ALL``).

    Tasks send the distinct values of a group's feature with their counts, or ``ACCURACY`` of them at even ranks, so a quantile's
    rank is off by one in ``ACCURACY`` at most."""
    parts = packed.mapInArrow(_value_counts(keys, folds), f"{B.key_schema(packed, keys)}, at int, fold int, v binary, c binary")
    cut = B.brought_together(parts, [*keys, "at"]).mapInArrow(
        _quantiles(keys, bins, fits or [ALL]), f"{B.key_schema(packed, keys)}, at int, fit int, cut array<double>")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "cut"))), lambda s: s["cut"])
    return cut.groupBy(*keys, "fit").agg(listed.alias("edges"))


def edges(rows: DataFrame, keys: list[str], bins: int = BINS) -> DataFrame:
    """``edges``: per feature of the group its distinct quantiles, rising."""
    packed = B.pack(rows.select(*keys, F.lit(0).alias("y"), "x"), keys, ["y"], ["x"])
    return edges_of(packed, keys, bins=bins).drop("fit")


def with_bins(rows: DataFrame, edge_table: DataFrame, keys: list[str]) -> DataFrame:
    """``bins``: how many edges of its feature each value passes."""
    number = F.zip_with("x", "edges", lambda v, e: F.size(F.filter(e, lambda c: c < v)))
    return rows.join(edge_table, keys).withColumn("bins", number).drop("edges")


def _bin(keys: list[str], numbers: list[str], fits: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            cuts = None
            for block in group:
                if cuts is None:
                    cuts = {e["fit"]: [np.asarray(c, dtype=float) for c in e["edges"]] for e in block.value("edges")}
                x, columns = block.matrix("x"), {c: block.array(c) for c in numbers}
                types = block.types(keys) | {"fit": pa.int32(), "n": pa.int32(), "d": pa.int32()} | {c: pa.binary() for c in [*numbers, "bins"]}
                for fit in fits:
                    part = np.ones(x.shape[1], dtype=bool) if fit == ALL else columns["fold"] != fit
                    if fit in cuts and part.any():
                        bins = np.stack([np.searchsorted(c, row[part]) for c, row in zip(cuts[fit], x)]).astype("u1")
                        yield B.batch_of(types, [(*key, fit, int(part.sum()), len(x), *[v[part].tobytes() for v in columns.values()], bins.tobytes())])
    return run


def binned(packed: DataFrame, edge_table: DataFrame, keys: list[str], numbers: list[str], fits: list[int] | None = None) -> DataFrame:
    """``(*keys, fit, n, d, *numbers, bins)``: the blocks with the bin of each value instead of the value, for every fit the rows that take part. The edges
    of a group are at most ``BINS`` - 1 per feature and fit, whatever its rows, so they are broadcast."""
    fits = fits or [ALL]
    listed = edge_table.groupBy(*keys).agg(F.collect_list(F.struct("fit", "edges")).alias("edges"))
    schema = f"{B.key_schema(packed, keys)}, fit int, n int, d int, " + ", ".join(f"{c} binary" for c in [*numbers, "bins"])
    return (packed.select(*keys, "n", "d", *numbers, "x").join(F.broadcast(listed), keys)
            .mapInArrow(_bin(keys, numbers, fits), schema).transform(stored, "blocks"))


# ---------------------------------------------------------------------------
# What a row weighs and which features a node may use, as hashes: the same numbers in Spark's xxhash64 and in numpy
# ---------------------------------------------------------------------------

def bootstrap_weight(tree: Column, row: str = "event_id", seed: int = 0) -> Column:
    """Poisson(1) count of a row in a tree's sample, from a hash of both."""
    u = F.pmod(F.xxhash64(F.col(row), tree, F.lit(seed)), F.lit(UNIT))
    out = F.lit(len(POISSON))
    for k in range(len(POISSON) - 1, -1, -1):
        out = F.when(u < POISSON[k], F.lit(k)).otherwise(out)
    return out.cast("long")


def offered(tree: Column, node: Column, features: Column, count: Column, seed: int = 0) -> Column:
    """The ``count`` features that a node may split on: those of smallest hash."""
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), features - 1), lambda f: F.struct(
        F.xxhash64(tree, node, f, F.lit(seed)).alias("h"), f.alias("f"))))
    return F.transform(F.slice(ranked, 1, count), lambda s: s["f"])


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_SEED = np.array([42], dtype=np.uint64)


def _turn(v: np.ndarray, by: int) -> np.ndarray:
    return (v << np.uint64(by)) | (v >> np.uint64(64 - by))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def hash_long(v: np.ndarray, h: np.ndarray = _SEED) -> np.ndarray:
    """Step of Spark's xxhash64 for a column of longs (``h``: of the columns before)."""
    h = (h + _P5 + np.uint64(8)) ^ (_turn(v.astype(np.int64).view(np.uint64) * _P2, 31) * _P1)
    return _mix(_turn(h, 27) * _P1 + _P4)


def hash_int(v, h: np.ndarray = _SEED) -> np.ndarray:
    """The same for a column of ints."""
    v = np.atleast_1d(np.asarray(v, dtype=np.int32)).view(np.uint32).astype(np.uint64)
    return _mix(_turn((h + _P5 + np.uint64(4)) ^ (v * _P1), 23) * _P2 + _P3)


def weights(event: np.ndarray, tree: int, seed: int = 0) -> np.ndarray:
    """``bootstrap_weight`` of the rows."""
    u = hash_int(seed, hash_int(tree, hash_long(event))) & np.uint64(UNIT - 1)
    return np.searchsorted(np.array(POISSON, dtype=np.uint64), u, side="right")


@lru_cache(maxsize=1 << 16)
def may_use(tree: int, node: int, features: int, count: int | None, seed: int) -> np.ndarray:
    """``offered``, rising; all features without ``count``."""
    if count is None:
        return np.arange(features)
    h = hash_int(seed, hash_int(np.arange(features), hash_int(node, hash_int(tree)))).view(np.int64)
    return np.sort(np.argsort(h, kind="stable")[:count])


def class_statistics(seed: int = 0, bagged: bool = True) -> Callable[[B.Block], Callable[[int], tuple[np.ndarray, np.ndarray]]]:
    """Weighted count of the positive class and of all rows: the gain below is then that of the Gini impurity."""
    def stat(block: B.Block):
        y = block.array("y").astype(np.int64)
        event = block.array("event_id") if bagged else None

        def of(tree: int):
            w = weights(event, tree, seed) if bagged else np.ones(len(y), dtype=np.int64)
            return w * y, w
        return of
    return stat


def _half_up(v: np.ndarray) -> np.ndarray:
    return (np.sign(v) * np.floor(np.abs(v) + 0.5)).astype(np.int64)


def gradients(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss at the rows' margins, in whole steps."""
    p = 1 / (1 + np.exp(-margin))
    return _half_up((y - p) * UNIT), np.maximum(_half_up(p * (1 - p) * UNIT), 1)


def log_loss(y: np.ndarray, margin: np.ndarray) -> int:
    """ln(1 + e^m) - y m, without overflow, summed in whole steps."""
    one = np.maximum(margin, 0) + np.log1p(np.exp(-np.abs(margin))) - y * margin
    return int(_half_up(one * UNIT).sum())


# ---------------------------------------------------------------------------
# Levels
# ---------------------------------------------------------------------------

def _step(bins: np.ndarray, n: int, rows: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at nodes that are split, and the children they go to."""
    f = feature[node]
    on = f >= 0
    rows, node, f = rows[on], node[on], f[on]
    return rows, 2 * node + 1 + (bins[f * n + rows] > cut[node])


def _count(bins: np.ndarray, n: int, rows: np.ndarray, local: np.ndarray, use: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(node, place of its feature, bin) -> sums of g and h and number of rows. ``use``: the features of each node of the level."""
    width, s = use.shape
    at = ((local * s)[:, None] + np.arange(s)) * BINS + bins[use[local] * n + rows[:, None]]
    at, size = at.ravel(), width * s * BINS
    first = np.bincount(at, weights=np.repeat(g[rows], s), minlength=size)
    # sums below 2^53: exact
    both = np.bincount(at, weights=np.repeat((h[rows] << COUNT_BITS) + 1, s), minlength=size).astype(np.int64)
    return np.stack([first.astype(np.int64), both >> COUNT_BITS, both & ((1 << COUNT_BITS) - 1)], axis=-1).reshape(width, s, BINS, 3)


def _use(tree: int, level: int, features: int, share: Callable[[int], int] | None, seed: int) -> np.ndarray:
    first = (1 << level) - 1
    return np.stack([may_use(tree, first + i, features, share and share(features), seed) for i in range(1 << level)])


def _splits(block: B.Block, trees: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(tree, node) -> feature (-1: none) and bin, from the group's ``splits``."""
    feature, cut = np.full(trees * many, -1), np.zeros(trees * many, dtype=np.int64)
    known = np.array(block.value("splits") or [], dtype=np.int64).reshape(-1, 3)
    feature[known[:, 0]], cut[known[:, 0]] = known[:, 1], known[:, 2]
    return feature.reshape(trees, many), cut.reshape(trees, many)


def _histograms(keys: list[str], trees: int, many: int, level: int, stat, share, seed: int):
    first = (1 << level) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            held: dict[int, np.ndarray] = {}
            feature = None
            for block in group:
                n, d, bins, of = block.value("n"), block.value("d"), block.array("bins"), stat(block)
                if feature is None:
                    feature, cut = _splits(block, trees, many)
                for tree in range(trees):
                    if level and not (feature[tree, first >> 1:first] >= 0).any():
                        continue
                    g, h = of(tree)
                    rows = np.flatnonzero(h > 0)
                    node = np.zeros(len(rows), dtype=np.int64)
                    for _ in range(level):
                        rows, node = _step(bins, n, rows, node, feature[tree], cut[tree])
                    if len(rows):
                        sums = _count(bins, n, rows, node - first, _use(tree, level, d, share, seed), g, h)
                        held[tree] = held[tree] + sums if tree in held else sums
            types = block.types(keys) | {"tree": pa.int32(), "d": pa.int32(), "sums": pa.binary()}
            yield B.batch_of(types, [(*key, tree, d, v.tobytes()) for tree, v in held.items()])
    return run


def _score(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    g, h = g.astype(float), h.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return g * g / (h + ridge)


def best_splits(sums: np.ndarray, use: np.ndarray, level: int, ridge: float, min_rows: int) -> list[tuple]:
    """``(node, feature, bin, g, h, n, g_left, h_left, n_left)`` of every node of a level that holds rows; feature -1 where no split gains."""
    left = sums.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    g, h, n = left[..., 0], left[..., 1], left[..., 2]
    wg, wh, wn = whole[..., 0], whole[..., 1], whole[..., 2]
    # the gain is only asked for where both sides hold rows
    may = (n >= max(min_rows, 1)) & (wn - n >= max(min_rows, 1)) & (wh > h)
    gain = np.where(may, _score(g, h, ridge) + _score(wg - g, wh - h, ridge) - _score(wg, wh, ridge), -np.inf)
    out = []
    for i in np.flatnonzero(wn[:, 0, 0]):
        f, b = np.unravel_index(gain[i].argmax(), gain[i].shape)   # the first of the highest: features and bins rise
        total = whole[i, 0, 0].tolist()
        node = (1 << level) - 1 + int(i)
        if gain[i, f, b] > MIN_GAIN:
            out.append((node, int(use[i, f]), int(b), *total, *left[i, f, b].tolist()))
        else:
            out.append((node, -1, 0, *total, 0, 0, 0))
    return out


NODE = "node int, feature int, bin int, g long, h long, n long, g_left long, h_left long, n_left long"
_NODE_TYPES = {c: pa.int32() if c in ("node", "feature", "bin") else pa.int64() for c in (p.split()[0] for p in NODE.split(", "))}


def _best(keys: list[str], level: int, ridge: float, min_rows: int, share, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, [*keys, "tree"]):
            sums = None
            for row in group:
                if sums is None:
                    use = _use(key[-1], level, row.value("d"), share, seed)
                    sums = np.zeros((*use.shape, BINS, 3), dtype=np.int64)
                sums += np.frombuffer(row.value("sums"), dtype=np.int64).reshape(sums.shape)
            yield B.batch_of(row.types([*keys, "tree"]) | _NODE_TYPES, [(*key, *t) for t in best_splits(sums, use, level, ridge, min_rows)])
    return run


def _named(found: list[DataFrame], columns: list[str], ridge: float) -> DataFrame:
    """``(*columns, node, feature, bin, value, n)`` of all levels; the children of the last level's splits are leaves."""
    def at(df: DataFrame, node, feature, cut, g, h, n) -> DataFrame:
        return df.select(*columns, node.alias("node"), feature.alias("feature"), cut.alias("bin"),
                         (g.cast("double") / (h.cast("double") + ridge)).alias("value"), n.alias("n"))
    c = F.col
    parts = [at(f, c("node"), c("feature"), c("bin"), c("g"), c("h"), c("n")) for f in found]
    last = found[-1].filter("feature >= 0")
    parts.append(at(last, 2 * c("node") + 1, F.lit(-1), F.lit(0), c("g_left"), c("h_left"), c("n_left")))
    parts.append(at(last, 2 * c("node") + 2, F.lit(-1), F.lit(0), c("g") - c("g_left"), c("h") - c("h_left"), c("n") - c("n_left")))
    return reduce(DataFrame.union, parts)


def _known_splits(found: list[DataFrame], keys: list[str], many: int, tree: Column) -> DataFrame:
    """``(*keys, splits)``: at most one entry per tree and node of a group, whatever its rows."""
    every = reduce(DataFrame.union, found).filter("feature >= 0")
    return every.groupBy(*keys).agg(F.flatten(F.collect_list(F.array(tree * many + F.col("node"), "feature", "bin"))).alias("splits"))


def grow_blocks(blocks: DataFrame, keys: list[str], trees: int, depth: int, stat, ridge: float = 0.0, min_rows: int = 1,
                share: Callable[[int], int] | None = None, seed: int = 0) -> DataFrame:
    """``grow`` on blocks with ``bins``."""
    many = 1 << (depth + 1)
    schema = B.key_schema(blocks, keys)
    found: list[DataFrame] = []
    for level in range(depth):
        if level == 0:
            asked = blocks.withColumn("splits", F.lit(None).cast("array<int>"))
        else:
            asked = blocks.join(F.broadcast(_known_splits(found, keys, many, F.col("tree"))), keys)
        sums = asked.mapInArrow(_histograms(keys, trees, many, level, stat, share, seed), f"{schema}, tree int, d int, sums binary")
        found.append(B.brought_together(sums, [*keys, "tree"]).mapInArrow(
            _best(keys, level, ridge, min_rows, share, seed), f"{schema}, tree int, {NODE}").transform(stored, "trees"))
    return _named(found, [*keys, "tree"], ridge)


def grow(rows: DataFrame, keys: list[str], trees: int, depth: int, stat, ridge: float = 0.0,
         min_rows: int = 1, share: Callable[[int], int] | None = None, seed: int = 0) -> DataFrame:
    """Nodes of ``trees`` trees for every group: ``(*keys, tree, node, feature, bin, value, n)``.

    ``rows``: keys, event_id, y and bins. ``share`` gives, from the number of features, how many a
    node may choose from (all unless given). A node with fewer than 2 * ``min_rows`` rows or without gain is a leaf."""
    return grow_blocks(B.pack(rows, keys, ["event_id", "y"], ["bins"]), keys, trees, depth, stat, ridge, min_rows, share, seed)


def assemble(nodes: DataFrame, edge_table: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """``(*keys, trees)``: the nodes of each group as arrays by node number."""
    size = (1 << (depth + 1)) - 1
    limit = F.get(F.get("edges", F.col("feature")), F.col("bin"))
    known = nodes.join(edge_table, keys).select(*keys, "tree", "node", F.struct(
        "feature", F.when(F.col("feature") >= 0, limit).otherwise(F.lit(0.0)).alias("threshold"), "value").alias("value"))
    entries = F.map_from_entries(F.collect_list(F.struct("node", "value")))
    slots = F.sequence(F.lit(0), F.lit(size - 1))

    def part(field: str, missing) -> Column:
        return F.transform(slots, lambda i: F.coalesce(F.try_element_at("by_node", i)[field], F.lit(missing)))
    tree = F.struct(part("feature", -1).alias("feature"), part("threshold", 0.0).alias("threshold"), part("value", 0.0).alias("value"))
    one = known.groupBy(*keys, "tree").agg(entries.alias("by_node")).select(*keys, "tree", tree.alias("arrays"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("tree", "arrays"))), lambda s: s["arrays"])
    return one.groupBy(*keys).agg(listed.alias("trees"))


def leaf_values(trees: Column, x: Column) -> Column:
    """Value of the leaf that ``x`` reaches in each tree; a missing feature value goes left."""
    def walk(t: Column) -> Column:
        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(t["feature"]) + 1)).cast("int"))

        def step(n: Column, _: Column) -> Column:
            right = F.coalesce(F.get(x, F.get(t["feature"], n)) > F.get(t["threshold"], n), F.lit(False))
            return F.when(F.get(t["feature"], n) < 0, n).otherwise(2 * n + 1 + right.cast("int"))
        return F.get(t["value"], F.aggregate(steps, F.lit(0), step))
    return F.transform(trees, walk)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def forest_probability(trees: Column, x: Column) -> Column:
    """Mean of the trees' leaf shares."""
    return total(leaf_values(trees, x)) / F.size(trees)


def boosted_probability(trees: Column, base: Column, rate: Column, x: Column) -> Column:
    """Log-odds of the group plus the stages' steps."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(base + rate * total(leaf_values(trees, x)))))


def root_share(features: int) -> int:
    """How many of a group's features a node of a forest chooses from: the root of their number, rounded up."""
    return int(np.ceil(np.sqrt(features)))


def fit_forest_groups(rows: DataFrame, keys: list[str], trees: int = 20, depth: int = 4, min_rows: int = 2, seed: int = 0) -> DataFrame:
    """``(*keys, trees)``: one random forest for every group."""
    packed = B.pack(rows, keys, ["event_id", "y"], ["x"])
    cut = edges_of(packed, keys).transform(stored, "trees")
    blocks = binned(packed, cut, keys, ["event_id", "y"])
    nodes = grow_blocks(blocks, keys, trees, depth, class_statistics(seed), min_rows=min_rows, share=root_share, seed=seed)
    return assemble(nodes, cut.drop("fit"), keys, depth)


# ---------------------------------------------------------------------------
# Boosting
# ---------------------------------------------------------------------------

def _margins(block: B.Block, known: list[dict], rate: float, many: int) -> np.ndarray:
    """Log-odds of the group plus the steps of its trees so far, in their order."""
    n, bins = block.value("n"), block.array("bins")
    margin = np.full(n, block.value("base"))
    for stage in sorted({t["stage"] for t in known}):
        feature, cut, value = np.full(many, -1), np.zeros(many, dtype=np.int64), np.zeros(many)
        for t in known:
            if t["stage"] == stage:
                feature[t["node"]], cut[t["node"]], value[t["node"]] = t["feature"], t["bin"], t["value"]
        at = np.zeros(n, dtype=np.int64)
        rows, node = np.arange(n), at
        while len(rows):
            rows, node = _step(bins, n, rows, node, feature, cut)
            at[rows] = node
        margin = margin + rate * value[at]
    return margin


def _boosting(keys: list[str], many: int, level: int, rate: float):
    """Counts of the tree of a stage at one level and, at its root, the loss before it."""
    first = (1 << level) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            held, loss, known = 0, 0, None
            for block in group:
                n, d, bins, y = block.value("n"), block.value("d"), block.array("bins"), block.array("y").astype(float)
                if known is None:
                    known, (feature, cut) = block.value("known") or [], _splits(block, 1, many)
                margin = _margins(block, known, rate, many)
                rows, node = np.arange(n), np.zeros(n, dtype=np.int64)
                for _ in range(level):
                    rows, node = _step(bins, n, rows, node, feature[0], cut[0])
                if level == 0:
                    loss += log_loss(y, margin)
                held = held + _count(bins, n, rows, node - first, _use(0, level, d, None, 0), *gradients(y, margin))
            types = block.types(keys) | {"d": pa.int32(), "loss": pa.int64(), "sums": pa.binary()}
            yield B.batch_of(types, [(*key, d, loss, held.tobytes())])
    return run


def _best_step(keys: list[str], level: int, ridge: float, min_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in B.by_group(batches, keys):
            sums, loss = None, 0
            for row in group:
                if sums is None:
                    use = _use(0, level, row.value("d"), None, 0)
                    sums = np.zeros((*use.shape, BINS, 3), dtype=np.int64)
                sums += np.frombuffer(row.value("sums"), dtype=np.int64).reshape(sums.shape)
                loss += row.value("loss")
            yield B.batch_of(row.types(keys) | {"loss_steps": pa.int64()} | _NODE_TYPES,
                             [(*key, loss, *t) for t in best_splits(sums, use, level, ridge, min_rows)])
    return run


def boost_blocks(blocks: DataFrame, base: DataFrame, cut: DataFrame, keys: list[str], stages: int, depth: int, rate: float,
                 ridge: float, min_rows: int, tol: float) -> tuple[DataFrame, DataFrame]:
    """``fit_boosted_groups`` on blocks with ``bins``; ``base``: the groups' log-odds. A pass over the blocks per level, and one for the last loss."""
    many = 1 << (depth + 1)
    schema = B.key_schema(blocks, keys)
    known_type = "array<struct<stage:int,node:int,feature:int,bin:int,value:double>>"
    state = base.select(*keys, "base", F.lit(None).cast("double").alias("before"), F.array().cast(known_type).alias("known"))
    losses, closed = [], []
    for stage in range(1, stages + 2):
        found: list[DataFrame] = []
        for level in range(depth if stage <= stages else 1):
            if level == 0:
                asked = state.select(*keys, "base", "known", F.lit(None).cast("array<int>").alias("splits"))
            else:
                asked = state.select(*keys, "base", "known").join(_known_splits(found, keys, many, F.lit(0)), keys)
            # a row per group, of bounded size
            sums = blocks.join(F.broadcast(asked), keys).mapInArrow(_boosting(keys, many, level, rate), f"{schema}, d int, loss long, sums binary")
            best = B.brought_together(sums, keys).mapInArrow(_best_step(keys, level, ridge * UNIT, min_rows), f"{schema}, loss_steps long, {NODE}")
            best = best.transform(stored, "trees")
            if level == 0:
                now = best.select(*keys, (F.col("loss_steps") / F.col("n") / UNIT).alias("loss"))
                both = state.join(now, keys)
                better = F.col("before").isNull() | (F.col("before") - F.col("loss") > tol * F.col("before"))
                # the last tree of a group that closes is not kept
                closed.append(both.filter(~better).select(*keys, F.filter("known", lambda t: t["stage"] < stage - 1).alias("known")))
                state = both.filter(better).drop("before").withColumnRenamed("loss", "before").transform(stored, "trees")
                losses.append(state.select(*keys, F.lit(stage - 1).alias("stage"), F.col("before").alias("loss")))
                if state.isEmpty():
                    break
                best = best.join(state.select(*keys), keys, "left_semi")
            found.append(best.drop("loss_steps"))
        if stage > stages or len(found) < depth:
            break
        grown = _named(found, keys, ridge * UNIT).groupBy(*keys).agg(F.collect_list(F.struct(
            F.lit(stage).alias("stage"), "node", "feature", "bin", "value")).alias("grown"))
        state = state.join(grown, keys).select(*keys, "base", "before", F.concat("known", "grown").alias("known"))
    kept = reduce(DataFrame.union, [*closed, state.select(*keys, "known")]).select(*keys, F.inline("known"))
    trees = assemble(kept.withColumnRenamed("stage", "tree"), cut, keys, depth)
    model = base.join(trees, keys, "left").select(*keys, F.coalesce("trees", F.array().cast(f"array<{TREE}>")).alias("trees"), "base",
                                                  F.lit(rate).alias("rate"))
    return model, reduce(DataFrame.union, losses)


def log_odds(share: Column) -> Column:
    share = F.least(F.greatest(share, F.lit(1e-3)), F.lit(1 - 1e-3))
    return F.log(share / (1 - share))


def fit_boosted_groups(spark: SparkSession, rows: DataFrame, keys: list[str], stages: int = 10, depth: int = 2, rate: float = 0.3,
                       ridge: float = 1.0, min_rows: int = 2, tol: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """Stage-wise boosting of the log loss for every group.

    Returns ``(*keys, trees, base, rate)`` and the losses ``(*keys, stage, loss)`` (stage 0: before any tree). Each stage grows one
    tree on the gradients at the rows' margins, which are computed where they are read, from the trees so far. A group whose loss falls by
    less than ``tol`` of itself is closed: it gets no further stage."""
    packed = B.pack(rows, keys, ["event_id", "y"], ["x"])
    cut = edges_of(packed, keys).transform(stored, "trees")
    base = rows.dropna(subset=keys).groupBy(*keys).agg(log_odds(F.avg(F.col("y").cast("double"))).alias("base")).transform(stored, "trees")
    return boost_blocks(binned(packed, cut, keys, ["y"]).drop("fit"), base, cut.drop("fit"), keys, stages, depth, rate, ridge, min_rows, tol)
