"""SimHash near-duplicates linked with BK-trees.

Fingerprint: A-Z lower-cased, words are runs without ASCII white space, shingles of
``shingle`` words joined by a space (fewer words: the whole sequence; none: fingerprint 0). A bit
is set when it is set in more than half of the shingles' XXH64 (seed 42) values.

Linking: texts are first reduced to distinct fingerprints. The trees are shards: a shard key is one
of 4 blocks of 16 bits with its value, and one of 4 sub-blocks of 12 bits of the other 48 bits with
its value. Up to 3 differing bits leave one block and one sub-block untouched, so every link lies
inside a shard. Keys held by one fingerprint are dropped before the shuffle of the shards. A key
held by more than ``tree_size`` fingerprints becomes several trees of about that size; every
fingerprint is a node of one of them and a query to all, so no task holds an unbounded tree. In a
tree, children are keyed by the Hamming distance to the parent and a search follows only edges
within the radius. A shard returns a spanning forest of its links (at most one row per fingerprint),
never all pairs.

Null texts count as empty (fingerprint 0, linked like any other); rows with a null doc_id get the
component of their fingerprint; repeated rows and repeated ids are kept as rows; extra columns
are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise, text_col
from oddsframe.llm.components import connected_components

BITS, SEED = 64, 42
SHINGLE, MAX_BITS = 3, 3
TREE_SIZE = 256
SLAB = 1 << 16  # shingles whose bits are counted at once


def simhash(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), SLAB):
        part = h[at:at + SLAB].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0])


class BKTree:
    """Integers under Hamming distance; children keyed by the distance to their parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        at = 0
        while self.values:
            d = (x ^ self.values[at]).bit_count()
            if d == 0:
                return
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = len(self.values)
                break
            at = nxt
        self.values.append(x)
        self.children.append({})

    def within(self, x: int, radius: int) -> list[int]:
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (x ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(self.values[at])
            kids = self.children[at]
            if kids:
                for e in range(max(1, d - radius), d + radius + 1):
                    if e in kids:
                        stack.append(kids[e])
        return found


def _forest(fps: list[int], member: list[bool], radius: int) -> Iterator[tuple[int, int]]:
    """Spanning links of one shard tree: nodes are the members, every row is a query."""
    tree = BKTree()
    for x, m in zip(fps, member):
        if m:
            tree.add(x)
    root = {x: x for x in fps}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in fps:
        for y in tree.within(x, radius):
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
    for x in root:
        if (r := find(x)) != x:
            yield x, r


def _search(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key, sub = rest["key"].to_numpy(), rest["sub"].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (sub[1:] != sub[:-1])) + 1
            if len(cut):
                yield _links(rest.iloc[:cut[-1]], cut[:-1], radius)
                rest = rest.iloc[cut[-1]:]
        if rest is not None and len(rest):
            yield _links(rest, np.array([], dtype=int), radius)
    return run


def _links(rows: pd.DataFrame, cuts: np.ndarray, radius: int) -> pd.DataFrame:
    fps, member = rows["fp"].to_numpy().view(np.uint64).tolist(), rows["member"].tolist()
    edge = [0, *cuts.tolist(), len(fps)]
    out: list[tuple[int, int]] = []
    for a, b in zip(edge, edge[1:]):
        out.extend(_forest(fps[a:b], member[a:b], radius))
    pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]}).drop_duplicates()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint's bits as a signed long, one row per row of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text")).mapInPandas(
        run, "doc_id long, fp long")


def _row_fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, row, hash, fp)`` of rows numbered by ``_simhash_row``; ``hash`` is the text's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield b[["doc_id", "row", "hash"]].assign(fp=fp)

    text = text_col()
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_simhash_row").alias("row"), F.xxhash64(text).alias("hash"),
                       text.alias("text")).mapInPandas(run, "doc_id long, row long, hash long, fp long")


def _shard_keys() -> F.Column:
    """The 16 shard keys of a fingerprint, as an array of longs."""
    fp, keys = F.col("fp"), []
    for i in range(4):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << (16 * i)) - 1))
        high = F.shiftleft(F.shiftrightunsigned(fp, 16 * (i + 1)), 16 * i) if i < 3 else F.lit(0).cast("long")
        rest = low.bitwiseOR(high)
        for j in range(4):
            sub = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((i * 4 + j) << 28).cast("long") + F.shiftleft(block, 12) + sub)
    return F.array(*keys)


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints (column ``fp``) that connect exactly those
    within ``max_bits`` of each other, directly or by a path of such links."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the shard keys are exact for at most 3 differing bits")
    keyed = nodes.select("fp", F.explode(_shard_keys()).alias("key"))
    held = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select("key", F.ceil(F.col("n") / F.lit(tree_size)).cast("int").alias("trees")))
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    shard = (keyed.join(held, "key")
             .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("sub"))
             .select("key", "sub", "fp", (F.col("own") == F.col("sub")).alias("member")))
    return (shard.repartition("key", "sub").sortWithinPartitions("key", "sub")
            .mapInPandas(_search(max_bits), "u long, v long").distinct())


def _placed(fps: DataFrame, least: F.Column, max_bits: int) -> DataFrame:
    """``(fp, least, root)`` per distinct fingerprint: an aggregate of its rows, and its group."""
    nodes = materialise(fps.groupBy("fp").agg(least.alias("least")), "simhash-nodes")
    roots = connected_components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row: 16 hex digits, and the smallest doc_id
    reachable over links of at most ``max_bits`` bits."""
    fps = materialise(fingerprints(docs, shingle), "simhash")
    placed = _placed(fps, F.min("doc_id"), max_bits)
    comp = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "root").join(comp, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: exactly one per group of linked fingerprints, the row of the smallest
    doc_id (null ids last), among these of the smallest text hash. Rows are numbered in a shared table, so
    rows with a null or repeated id are rows of their own."""
    rows = materialise(docs.withColumn("_simhash_row", F.monotonically_increasing_id()), "simhash-rows")
    fps = materialise(_row_fingerprints(rows, shingle), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash", "row"))
    keep = (_placed(fps, first, max_bits).groupBy("root").agg(F.min("least").alias("least"))
            .select(F.col("least.row").alias("_kept_row")))
    return rows.join(keep, F.col("_simhash_row") == F.col("_kept_row"), "left_semi").select(*docs.columns)
