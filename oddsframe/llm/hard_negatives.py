"""Hard-negative mining with angular triangle filtering.

Vectors become integers (``floor(scale * x)``). Reference directions are spread by farthest-first choice over a bounded
sample; every row stores its norm and its angles to them. Angles obey the triangle inequality on the sphere, so for an
anchor a and a row x every reference r gives |a_r - x_r| <= angle(a, x) <= min(a_r + x_r, 2 pi - a_r - x_r). The tightest of
these, widened by ``SLACK`` for rounding, is an interval of cosines, and times both norms (again widened) one of
scores. Integer scores are taken only of rows whose interval meets a window that matters:

1. positives: rows of the anchor's label, by falling upper bound, while it reaches the k-th best score so far;
2. negatives: rows of other labels whose interval meets the score window of one of the anchor's positives.

Nothing is dropped without this proof, whatever the references are; they only decide how many rows are scored.
Rows of a shard are held in cells of one label, a nearest reference and near angles to it. A cell's interval holds those of all its
rows, so a whole cell is met or left out at once, and the anchors that meet it are scored against it in one product. Where a score
may pass 2^53, rows are bounded one by one and scored as Python integers instead.
Anchors are met in blocks of ``ANCHOR_ROWS`` by shards of about ``SHARD_ROWS`` rows dealt by row number, so a label that
holds a third of all rows is split like any other. The best of every shard are merged per anchor (and positive).

Rows with a null id, a null label, a null or empty vector or a null or non-finite component take no part (nor does a
component that no double holds once scaled). A row meets rows of its own length only. Rows with the anchor's id are its own, neither
positive nor negative; repeated rows are candidates each; repeated anchor rows count once. Ties go to the smaller id.
Scores are exact up to 38 digits and ranked as such; the result holds those that pass 64 bits at the bound. Extra columns are dropped; an empty table
gives an empty result. Fewer positives or negatives than asked for: all there are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise
from oddsframe.llm.integer_scores import EXACT, as_long, as_text, largest, products, taking_part, whole

SHARD_ROWS, ANCHOR_ROWS = 16384, 512
REFERENCES, SAMPLE = 16, 1024   # reference directions of a length, and rows from which they are chosen
SLACK = 1e-6                    # radians: arccos loses half the digits near 0 and pi
CELL_ROWS = 128                 # rows that are bounded together
FIRST = 64                      # rows scored at once when positives are looked for


def references(sample: list[list[float]], count: int = REFERENCES) -> dict[int, np.ndarray]:
    """Unit directions per vector length, each the farthest by angle from those before it."""
    found = {}
    for d in sorted({len(v) for v in sample}):
        x = np.array([v for v in sample if len(v) == d], dtype=np.float64)
        norm = np.linalg.norm(x, axis=1)
        x = x[(norm > 0) & np.isfinite(norm)]
        if len(x):
            x = x / np.linalg.norm(x, axis=1)[:, None]
            chosen, nearest = [0], x @ x[0]
            while len(chosen) < min(count, len(x)) and nearest.min() < 1 - 1e-9:
                chosen.append(int(nearest.argmin()))
                nearest = np.maximum(nearest, x @ x[chosen[-1]])
            found[d] = x[chosen]
    return found


def angles(x: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Angles of the rows of ``x`` to the directions; a zero vector's are set to 0 (its scores are 0 anyway)."""
    if directions is None:
        return np.zeros((len(x), 0))
    norm = np.linalg.norm(x, axis=1)
    unit = np.divide(x, norm[:, None], out=np.zeros_like(x), where=(norm[:, None] > 0) & np.isfinite(norm[:, None]))
    return np.where((norm > 0)[:, None], np.arccos(np.clip(unit @ directions.T, -1.0, 1.0)), 0.0)


def bounds(norms: np.ndarray, held: np.ndarray, norm: float, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows (``norms``, angles ``held``) can have with a vector (``norm``, ``angle``)."""
    size = norms * norm
    if held.shape[1]:
        apart, both = np.abs(held - angle), held + angle
        least = np.maximum(apart.max(axis=1) - 2 * SLACK, 0.0)
        most = np.minimum(np.minimum(both, 2 * math.pi - both).min(axis=1) + 2 * SLACK, math.pi)
        low, high = size * np.cos(most), size * np.cos(least)
    else:
        low, high = -size, size
    room = size * 1e-9 + 1.0
    return low - room, high + room


class Shard:
    """Rows of one shard with their stored angles."""

    def __init__(self, rows: pd.DataFrame) -> None:
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        self.ids = rows["vec_id"].to_numpy()[order]
        self.labels = rows["label"].to_numpy()[order]
        self.x = np.stack(rows["x"].to_list()).astype(np.float64)[order]
        self.held = np.stack(rows["angles"].to_list()).astype(np.float64)[order]
        self.norms = rows["norm"].to_numpy()[order]
        self.sizes = largest(self.x)
        # rows whose square may pass 2^53 have no trusted bound: they are always scored
        self.wide = ~(self.x.shape[1] * self.sizes ** 2 < EXACT)

    def _bounds(self, norm: float, angle: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(q) * float(np.abs(q).max()) ** 2 < EXACT:
            return np.full(len(self.ids), -np.inf), np.full(len(self.ids), np.inf)
        low, high = bounds(np.where(self.wide, 0.0, self.norms), self.held, norm, angle)
        return np.where(self.wide, -np.inf, low), np.where(self.wide, np.inf, high)

    def positives(self, anchor, k: int) -> list[tuple[int, int]]:
        """The best k ``(id, score)`` of the anchor's label."""
        q, angle = np.asarray(anchor.x, dtype=np.float64), np.asarray(anchor.angles, dtype=np.float64)
        _, high = self._bounds(anchor.norm, angle, q)
        rows = np.flatnonzero((self.labels == anchor.label) & (self.ids != anchor.vec_id))
        rows = rows[np.argsort(-high[rows], kind="stable")]
        best: list[tuple[int, int]] = []
        at, step = 0, FIRST
        while at < len(rows) and (len(best) < k or high[rows[at]] >= -best[k - 1][0]):
            here = rows[at:at + step]
            scores = products(self.x[here], self.sizes[here], q)
            best = sorted(best + [(-int(s), int(i)) for s, i in zip(scores, self.ids[here])])[:k]
            at, step = at + step, step * 2
        return [(i, -s) for s, i in best]

    def negatives(self, anchor, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """Per score window the best k ``(id, score)`` of other labels inside it."""
        q, angle = np.asarray(anchor.x, dtype=np.float64), np.asarray(anchor.angles, dtype=np.float64)
        low, high = self._bounds(anchor.norm, angle, q)
        meets = np.zeros(len(self.ids), dtype=bool)
        for least, most in windows:
            if least <= most:
                meets |= (high >= least) & (low <= most)
        rows = np.flatnonzero(meets & (self.labels != anchor.label) & (self.ids != anchor.vec_id))
        scores = products(self.x[rows], self.sizes[rows], q)
        order = np.lexsort((self.ids[rows], -scores)) if scores.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda i: (-scores[i], self.ids[rows[i]])), dtype=np.int64)
        ranked, ids = scores[order], self.ids[rows][order]
        found = []
        for least, most in windows:
            inside = np.flatnonzero((ranked >= least) & (ranked <= most))[:k] if least <= most else []
            found.append([(int(ids[i]), int(ranked[i])) for i in inside])
        return found


class Cells:
    """Rows of one shard in cells of one label and near angles, each with the interval of its rows' norms and angles."""

    def __init__(self, rows: pd.DataFrame) -> None:
        held, labels = np.stack(rows["angles"].to_list()).astype(np.float64), rows["label"].to_numpy().astype(str)
        near = held.argmin(axis=1) if held.shape[1] else np.zeros(len(rows), dtype=np.int64)
        angle = held[np.arange(len(rows)), near] if held.shape[1] else np.zeros(len(rows))
        order = np.lexsort((angle, near, labels))
        held, labels = held[order], labels[order]
        self.ids, self.x = rows["vec_id"].to_numpy()[order], np.stack(rows["x"].to_list()).astype(np.float64)[order]
        self.size = float(np.abs(self.x).max())
        norms = rows["norm"].to_numpy()[order]
        edge = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True])
        self.starts = np.concatenate([np.arange(a, b, CELL_ROWS) for a, b in zip(edge[:-1], edge[1:])])
        self.ends = np.r_[self.starts[1:], len(labels)]
        self.labels = labels[self.starts]
        self.held = np.minimum.reduceat(held, self.starts, axis=0), np.maximum.reduceat(held, self.starts, axis=0)
        self.norms = np.minimum.reduceat(norms, self.starts), np.maximum.reduceat(norms, self.starts)

    def exact(self, q: np.ndarray) -> bool:
        """Whether every product and sum with the rows of ``q`` is exact in doubles."""
        return self.x.shape[1] * self.size * float(np.abs(q).max()) < EXACT and self.x.shape[1] * max(self.size, float(np.abs(q).max())) ** 2 < EXACT

    def bounds(self, norm: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that a row of a cell can have with an anchor, (anchors, cells)."""
        small, large = (n[None] * norm[:, None] for n in self.norms)
        if not angle.shape[1]:
            return -large - large * 1e-9 - 1.0, large + large * 1e-9 + 1.0
        least, most = np.zeros(large.shape), np.full(large.shape, math.pi)
        for r in range(angle.shape[1]):
            a, lo, hi = angle[:, r, None], self.held[0][None, :, r], self.held[1][None, :, r]
            least = np.maximum(least, np.maximum(lo - a, a - hi) - 2 * SLACK)
            most = np.minimum(most, np.minimum(hi + a, 2 * math.pi - lo - a) + 2 * SLACK)
        near, far, room = np.cos(least), np.cos(np.minimum(most, math.pi)), large * 1e-9 + 1.0
        return np.minimum(far * small, far * large) - room, np.maximum(near * small, near * large) + room

    def best(self, q: np.ndarray, own: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray,
             most: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """``(anchor, window, id, score)`` of the best k rows of every anchor and window, best first. A cell is left out once its
        interval meets no window, or lies under the k-th best score of each."""
        floor = np.where(least <= most, least, np.inf)
        at, win, ids, scores = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, self.ids.dtype, np.float64))
        for c in np.argsort(-high.max(axis=0), kind="stable"):
            meets = np.flatnonzero(allowed[:, c] & ((high[:, c, None] >= floor) & (low[:, c, None] <= most)).any(axis=1))
            if not len(meets):
                continue
            here = slice(self.starts[c], self.ends[c])
            s = q[meets] @ self.x[here].T
            i, r = np.nonzero((s >= floor[meets].min(axis=1)[:, None]) & (s <= most[meets].max(axis=1)[:, None])
                              & (self.ids[here][None] != own[meets][:, None]))
            found, a, one = s[i, r], meets[i], self.ids[here][r]
            i, j = np.nonzero((found[:, None] >= floor[a]) & (found[:, None] <= most[a]))
            if not len(i):
                continue
            at, win = np.r_[at, a[i]], np.r_[win, j]
            ids, scores = np.r_[ids, one[i]], np.r_[scores, found[i]]
            order = np.lexsort((ids, -scores, win, at))
            at, win, ids, scores = at[order], win[order], ids[order], scores[order]
            first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (win[1:] != win[:-1])])
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            full = rank == k - 1
            floor[at[full], win[full]] = scores[full]
            at, win, ids, scores = (v[rank < k] for v in (at, win, ids, scores))
        return at, win, ids, scores


def _cells(rows: pd.DataFrame, anchors: pd.DataFrame):
    """The shard in cells and the anchors' vectors, or nothing where a score may not be exact in doubles."""
    q = np.stack(anchors["x"].to_list()).astype(np.float64)
    cells = Cells(rows)
    return (cells, q, *cells.bounds(anchors["norm"].to_numpy(), np.stack(anchors["angles"].to_list()).astype(np.float64))) if cells.exact(q) else None


def _windows(scores, low: int, high: int) -> list[tuple[int, int]]:
    """Whole scores s with low * p <= 100 * s <= high * p, for each positive score p."""
    return [(-((-low * int(p)) // 100), (high * int(p)) // 100) for p in scores]


def _positives(k: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        met = _cells(rows, anchors) if len(rows) and len(anchors) else None
        if met:
            cells, q, low, high = met
            mine = anchors["label"].to_numpy().astype(str)[:, None] == cells.labels[None]
            every = np.full((len(q), 1), np.inf)
            at, _, ids, scores = cells.best(q, anchors["vec_id"].to_numpy(), mine, low, high, -every, every, k)
            out = [(key, int(i), as_text(s)) for key, i, s in zip(anchors["anchor_key"].to_numpy()[at], ids, scores)]
        elif len(rows) and len(anchors):
            shard = Shard(rows)
            for a in anchors.itertuples(index=False):
                out += [(a.anchor_key, i, as_text(s)) for i, s in shard.positives(a, k)]
        return pd.DataFrame(out, columns=["anchor_key", "positive_id", "score"])
    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        met = _cells(rows, anchors) if len(rows) and len(anchors) else None
        if met:
            cells, q, lowest, highest = met
            other = anchors["label"].to_numpy().astype(str)[:, None] != cells.labels[None]
            windows = [_windows([p["score"] for p in a], low, high) for a in anchors["positives"]]
            least, most = np.full((len(q), max(map(len, windows))), np.inf), np.full((len(q), max(map(len, windows))), -np.inf)
            for n, of_anchor in enumerate(windows):
                for j, (a, b) in enumerate(of_anchor):
                    least[n, j], most[n, j] = a, b
            at, win, ids, scores = cells.best(q, anchors["vec_id"].to_numpy(), other, lowest, highest, least, most, k)
            out = [(key, int(n), int(i), as_text(s)) for key, n, i, s in zip(anchors["anchor_key"].to_numpy()[at], win, ids, scores)]
        elif len(rows) and len(anchors):
            shard = Shard(rows)
            for a in anchors.itertuples(index=False):
                found = shard.negatives(a, _windows([p["score"] for p in a.positives], low, high), k)
                out += [(a.anchor_key, n, i, as_text(s)) for n, hits in enumerate(found) for i, s in hits]
        return pd.DataFrame(out, columns=["anchor_key", "at", "negative_id", "score"])
    return run


def with_angles(vectors: DataFrame, scale: int, vec: str, key: str, label: str) -> DataFrame:
    """``(vec_id, label, d, x, norm, angles)`` of the rows that take part, in a shared table."""
    spark = vectors.sparkSession
    # labels of any type: equal labels have equal text
    rows = taking_part(vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull()), vec, scale)
    x = materialise(rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.size(vec).alias("d"),
                                whole(vec, scale).alias("x")), "negatives-vectors")
    sample = [r.x for r in x.orderBy(F.xxhash64("vec_id", "x")).limit(SAMPLE).select("x").collect()]  # at most SAMPLE rows
    found = references(sample)

    def measure(batches):
        for pdf in batches:
            pdf = pdf.copy()
            held, norms = [None] * len(pdf), np.zeros(len(pdf))
            for d, places in pdf.groupby("d").indices.items():
                part = np.stack([pdf["x"].iloc[i] for i in places]).astype(np.float64)
                norms[places] = np.linalg.norm(part, axis=1)
                for i, row in zip(places, angles(part, found.get(int(d)))):
                    held[i] = row
            pdf["norm"], pdf["angles"] = norms, held
            yield pdf

    return materialise(x.mapInPandas(measure, "vec_id long, label string, d int, x array<double>, norm double, angles array<double>"),
                       "negatives-angles")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, vec: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for every row whose ``vec_id``
    satisfies ``is_anchor`` and each of its best ``positives``, the best ``negatives`` with a score of low to
    high percent of the positive's."""
    x = with_angles(vectors, scale, vec, key, label)
    anchors = (x.filter(is_anchor).dropDuplicates(["vec_id", "label", "x"])
               .withColumn("anchor_key", F.xxhash64("vec_id", "label", "x")))
    n, n_anchors = x.count(), anchors.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_anchors / ANCHOR_ROWS))
    keys = ["shard", "block", "d"]
    spread = lambda c, size: F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias(c)
    left = x.select(F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
                    "d", "vec_id", "label", "x", "norm", "angles", spread("block", blocks)).groupBy(*keys)

    def meet(them: DataFrame, fn, schema: str) -> DataFrame:
        # columns renewed by alias: both sides come from one table, and a side that shares columns with the other is pruned
        right = them.select(F.pmod(F.hash("anchor_key"), F.lit(blocks)).alias("block"),
                            *[F.col(c).alias(c) for c in them.columns], spread("shard", shards))
        return left.cogroup(right.groupBy(*keys)).applyInPandas(fn, schema).withColumn("score", F.col("score").cast("decimal(38,0)"))

    best = Window.partitionBy("anchor_key").orderBy(F.col("score").desc(), "positive_id")
    chosen = (meet(anchors, _positives(positives), "anchor_key long, positive_id long, score string")
              .withColumn("at", F.row_number().over(best)).filter(F.col("at") <= positives)
              .groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("at", "positive_id", F.col("score").cast("string").alias("score"))))
                                         .alias("positives")))
    ready = materialise(anchors.join(chosen, "anchor_key"), "negatives-anchors")
    per = Window.partitionBy("anchor_key", "at").orderBy(F.col("score").desc(), "negative_id")
    found = (meet(ready, _negatives(negatives, low, high), "anchor_key long, at int, negative_id long, score string")
             .withColumn("rank", F.row_number().over(per)).filter(F.col("rank") <= negatives))
    positive = F.get("positives", F.col("at"))
    return (found.join(ready.select("anchor_key", F.col("vec_id").alias("anchor_id"), "positives"), "anchor_key")
            .select("anchor_id", positive["positive_id"].alias("positive_id"), "rank", "negative_id",
                    as_long(positive["score"]).alias("positive_score"), as_long(F.col("score")).alias("negative_score")))
