"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors become integers (``floor(scale * x)``). The index is made of shards of about ``SHARD_ROWS``
vectors; in a shard every dimension has a posting list sorted by value, cut in segments. For a query a
segment's impact is the most that any of its postings adds over the least that the dimension can
add, so impacts are never negative. Impacts are quantised to ``LEVELS`` steps and segments are processed
by descending step. After every step a vector's score is at most what it has gathered plus the impacts
still open; vectors for which that is less than the k-th best of some exact scores are out for good.
When no more than the share ``ENOUGH`` of the shard is left, these are rescored exactly, else
the next step follows. Nothing is dropped without this proof. The best k of every shard are merged per query.

Queries meet shards in blocks of ``QUERY_ROWS``: a task holds one shard and one block.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null
id. Vectors so large that sums of their products may pass 2^53 stay out of the index: they are scored exactly against every
query, as is every row of the shard against such a query. Scores are ranked by up to 38 digits; those that pass 64 bits are held at
the bound in the result. A query meets vectors of its own length only. Rows with the query's id are its own and no candidates for it; repeated
rows are candidates each; repeated query rows count once. Ties go to the smaller id. Extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise
from oddsframe.llm.integer_scores import EXACT, as_long, as_text, largest, products, taking_part, whole

SHARD_ROWS, QUERY_ROWS = 16384, 512
SEGMENT, LEVELS, ENOUGH = 128, 8, 0.25


def quantised(vectors: DataFrame, scale: int = 256, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(vec_id, x)``: integer vectors of the rows that take part."""
    return (taking_part(vectors.filter(F.col(key).isNotNull()), vec, scale)
            .select(F.col(key).cast("long").alias("vec_id"), whole(vec, scale).alias("x")))


class ShardIndex:
    """Posting lists of one shard, sorted by value per dimension and cut in segments."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.all_ids, self.all_x = ids[order], x[order]
        self.sizes = largest(self.all_x)
        narrow = x.shape[1] * self.sizes ** 2 < EXACT / 4   # sums of impacts of two such vectors are exact in doubles
        self.wide = np.flatnonzero(~narrow)
        self.place = np.flatnonzero(narrow)
        self.ids, self.x = self.all_ids[narrow], self.all_x[narrow]
        self.m, self.d = self.x.shape
        if not self.m:
            return
        self.exact = self.x
        self.rows = np.argsort(self.x, axis=0, kind="stable").T.copy()  # d x m, rising values
        self.values = np.take_along_axis(self.exact.T, self.rows, axis=1)
        self.start = np.arange(0, self.m, SEGMENT)
        self.stop = np.minimum(self.start + SEGMENT, self.m)
        self.low, self.high = (self.values[:, i].astype(np.int64) for i in (self.start, self.stop - 1))

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The best ``(vec_id, score)`` of the shard, at most k, by exact score and then id."""
        if self.m and len(q) * float(np.abs(q).max()) ** 2 < EXACT / 4:
            possible = np.concatenate([self.place[self._possible(query_id, q.astype(np.int64), k)], self.wide])
        else:
            possible = np.arange(len(self.all_ids))
        possible = possible[self.all_ids[possible] != query_id]
        ids, scores = self.all_ids[possible], products(self.all_x[possible], self.sizes[possible], q)
        if scores.dtype == object:
            best = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
        else:
            best = np.lexsort((ids, -scores))[:k]
        return [(int(ids[i]), int(scores[i])) for i in best]

    def _possible(self, query_id: int, q: np.ndarray, k: int) -> np.ndarray:
        """Indexed rows that the bounds do not rule out of the best k."""
        a, b = q[:, None] * self.low, q[:, None] * self.high
        floor = np.minimum(a[:, 0], b[:, -1])
        impact = np.maximum(a, b) - floor[:, None]
        most = int(impact.max())
        step = impact * LEVELS // (most + 1)
        own = self.ids == query_id
        gathered = np.zeros(self.m, dtype=self.exact.dtype)
        weight, base = q.astype(self.exact.dtype), floor.astype(self.exact.dtype)
        possible = np.flatnonzero(~own)
        # rising values: a dimension's impacts fall or rise along its segments with the weight's sign,
        # so the segments of one step are one run of the posting list
        at = np.arange(step.shape[1])
        for level in range(int(step.max()), -1, -1):
            here = step == level
            for d in np.flatnonzero(here.any(axis=1)).tolist():
                run = at[here[d]]
                a, b = self.start[run[0]], self.stop[run[-1]]
                gathered[self.rows[d, a:b]] += weight[d] * self.values[d, a:b] - base[d]
            open_ = np.where(step < level, impact, 0).max(axis=1).sum()
            if len(possible) > k:
                best = possible[np.argpartition(-gathered[possible], k - 1)[:k]]
                bound = (self.exact[best] @ weight - base.sum()).min()  # k exact scores: no worse one is among the best
                possible = possible[gathered[possible] + open_ >= bound]
            if len(possible) <= max(k, ENOUGH * self.m):
                break
        return possible


def _search(k: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            index = ShardIndex(rows["vec_id"].to_numpy(), np.stack(rows["x"].to_list()).astype(np.float64))
            for qid, query, x in zip(queries["query_key"], queries["query_id"], queries["query_x"]):
                out += [(qid, query, v, as_text(s)) for v, s in index.top(query, np.asarray(x, dtype=np.float64), k)]
        return pd.DataFrame(out, columns=["query_key", "query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best candidates of every row of ``vectors`` (columns
    vec_id and embedding) for which ``is_query`` holds."""
    x = materialise(quantised(vectors, scale).withColumn("d", F.size("x")), "topk-vectors")
    queries = (x.filter(is_query).dropDuplicates(["vec_id", "x"])
               .select(F.xxhash64("vec_id", "x").alias("query_key"), F.col("vec_id").alias("query_id"),
                       F.col("x").alias("query_x"), F.col("d").alias("query_d")))
    n, n_queries = x.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_queries / QUERY_ROWS))
    spread = lambda c, size: F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias(c)
    left = x.select(F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
                    "d", "vec_id", "x", spread("block", blocks))
    right = queries.select(F.pmod(F.hash("query_key"), F.lit(blocks)).alias("block"), F.col("query_d").alias("d"), "query_key", "query_id", "query_x",
                           spread("shard", shards))
    keys = ["shard", "block", "d"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _search(k), "query_key long, query_id long, vec_id long, score string").withColumn("score", F.col("score").cast("decimal(38,0)"))
    w = Window.partitionBy("query_key", "query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", as_long(F.col("score")).alias("score")))
