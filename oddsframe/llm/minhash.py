"""MinHash fingerprints: universal hash permutations over word shingles in vectorised numpy.

A text's shingles are its runs of ``shingle`` white-space separated lower-cased words (fewer words: the
whole sequence; none: no shingle). Shingle hashes go through ``PERMUTATIONS`` multiply-shift functions; the
least value of each, cut to 16 bits, is one component. The fingerprint is the components in hex. Equal
texts have equal fingerprints; the likeness of two fingerprints is their share of equal
components, an estimate of the Jaccard similarity of the shingle sets.

``edited_fingerprints`` compares every document with an edited text and with the next document in
descending doc_id order. The next id is found from ids alone (range partitions, windows inside them, and one
row per partition for the borders). Texts are not shuffled where neighbours in id order are neighbours
in the input: one pass over the input guesses each row's next document from the row beside it, and the
guesses are checked against the true next ids. Rows with a wrong guess, in whatever number, are
done again with their texts joined by id.

``near_duplicates`` groups signature bands in Spark and verifies the Jaccard similarity of the sets: see ``classes``.

Null texts are empty. Rows with a null doc_id come last in the order, so their next document is the first;
of several rows with the next id the one with the least text counts; without any id the next text is
empty. Repeated rows give a row each, extra columns are dropped, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise, text_col
from oddsframe.llm.components import connected_components

SHINGLE, SIMILARITY = 5, 0.8
PERMUTATIONS, BANDS = 64, 16
SLAB = 1 << 13  # shingles that go through all permutations at once
EMPTY = np.zeros(PERMUTATIONS, dtype=np.uint16)
WORDS_MAX = 1_000_000
BROADCAST_ROWS = 100_000  # pairs of ids (16 bytes each) that may be broadcast
GROUP, MET = 256, 4096  # texts of a band group that a task holds at once, and those that it compares with them

_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(0, 2 ** 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2 ** 63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(0, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_MAX:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 1)
        return h


def shingles(text: str, words: dict, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's shingles, in order, repeats included."""
    w = text.lower().split()
    h = np.fromiter(map(words.__getitem__, w), dtype=np.uint64, count=len(w))
    k = min(shingle, len(h))
    if not k:
        return h
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out += (h[i:len(h) - k + 1 + i] ^ np.uint64(k)) * _PLACE[i]
    return out ^ (out >> np.uint64(29))


def signature(hashes: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return EMPTY
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), SLAB):
        part = hashes[at:at + SLAB]
        np.minimum(least, (_MULT[:, None] * part[None, :] + _ADD[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(20)).astype(np.uint16)


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """``text`` with its last third of code points replaced by the first as many of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


ROW = ("doc_id long, node long, next_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")


class _Rows:
    """Builds result rows; keeps the word hashes of its task."""

    def __init__(self, shingle: int) -> None:
        self.words, self.shingle = _WordHash(), shingle

    def sig(self, text: str) -> np.ndarray:
        return signature(shingles(text, self.words, self.shingle))

    def row(self, doc_id, node, text: str, sig: np.ndarray, next_id, following: str, next_sig: np.ndarray) -> tuple:
        new = edited(text, following)
        new_sig = self.sig(new)
        return (doc_id, node, next_id, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), as_text(sig),
                as_text(new_sig), likeness(sig, new_sig), likeness(sig, next_sig))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in ROW.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "next_id": "Int64", "n_chars": "Int64"})


def _guess(shingle: int):
    """A row per document: done with the nearer of its neighbours in the input whose id is smaller,
    or with nothing (next_id null) where neither is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, before = _Rows(shingle), None  # before: id, node, text, signature, row so far
        for b in batches:
            out = []
            for doc_id, node, text in zip(b["doc_id"].array, b["node"], b["text"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                here = [doc_id, node, text, make.sig(text), None]
                if before is not None:
                    if doc_id is not None and before[0] is not None:
                        if doc_id > before[0]:
                            here[4] = make.row(*here[:4], before[0], *before[2:4])
                        elif doc_id < before[0] and (before[4] is None or before[4][2] < doc_id):
                            before[4] = make.row(*before[:4], here[0], *here[2:4])
                    out.append(before[4] or _bare(before))
                before = here
            yield _frame(out)
        if before is not None:
            yield _frame([before[4] or _bare(before)])
    return run


def _bare(row: list) -> tuple:
    return (row[0], row[1], None, len(row[2]), None, as_text(row[3]), None, None, None)


def next_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id, next_rows)`` per distinct id: the next smaller id (after the smallest: the
    largest) and how many rows have it."""
    spark = docs.sparkSession
    ids = docs.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(ids.repartitionByRange(parts, F.col("doc_id").desc())
                        .withColumn("part", F.spark_partition_id()), "minhash-ids")
    item = F.struct("doc_id", "n_rows")
    heads = dealt.groupBy("part").agg(F.max(item).alias("head"))  # one row per partition
    by_part = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("border"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").desc())
    return (dealt.withColumn("following", F.lead(item).over(inside)).join(F.broadcast(after), "part")
            .withColumn("following", F.coalesce("following", "border"))
            .select("doc_id", F.col("following.doc_id").alias("next_id"), F.col("following.n_rows").alias("next_rows")))


def _again(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = _Rows(shingle)
        for b in batches:
            rows = []
            for doc_id, node, text, next_id, following in zip(b["doc_id"].array, b["node"], b["text"], b["next_id"].array, b["following"]):
                following = following or ""
                rows.append(make.row(doc_id, node, text, make.sig(text), next_id, following, make.sig(following)))
            yield _frame(rows)
    return run


def edited_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, next_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    class_id as in ``near_duplicates``."""
    texts = _noded(docs)
    guessed = materialise(texts.mapInPandas(_guess(shingle), ROW), "minhash-guessed")
    follow = materialise(next_ids(guessed), "minhash-next")
    right = F.col("g.next_id").eqNullSafe(F.col("f.next_id")) & (F.col("f.next_rows") == 1)
    open_ = (guessed.alias("g").join(follow.alias("f"), F.col("g.doc_id") == F.col("f.doc_id")).filter(~right)
             .select("f.doc_id", "f.next_id").distinct())
    open_ = materialise(open_, "minhash-open")
    small = open_.count() <= BROADCAST_ROWS
    maybe = F.broadcast if small else (lambda df: df)
    done = (guessed.filter(F.col("doc_id").isNotNull()).join(maybe(open_.select("doc_id")), "doc_id", "left_anti"))
    following = (texts.join(maybe(open_.select(F.col("next_id").alias("doc_id")).distinct()), "doc_id", "left_semi")
                 .groupBy(F.col("doc_id").alias("next_id")).agg(F.min("text").alias("following")))
    again = texts.join(maybe(open_), "doc_id").join(following, "next_id").select("doc_id", "node", "text", "next_id", "following")
    # rows without an id: the next document is the first in the order
    first = follow.agg(F.max("doc_id").alias("next_id")).first()["next_id"]
    head = (texts.filter(F.col("doc_id") == F.lit(first).cast("long")).groupBy(F.col("doc_id").alias("next_id"))
            .agg(F.min("text").alias("following")))
    without = (texts.filter(F.col("doc_id").isNull()).withColumn("next_id", F.coalesce("doc_id", F.lit(first).cast("long")))
               .join(head, "next_id", "left").select("doc_id", "node", "text", "next_id", "following"))
    redone = again.unionByName(without).mapInPandas(_again(shingle), ROW)
    rows = done.select(*[c.split()[0] for c in ROW.split(", ")]).unionByName(redone)
    return rows.join(classes(texts.select("node", "text"), guessed, shingle), "node").drop("node")


def _signed(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = _Rows(shingle)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "node": b["node"], "fingerprint": [as_text(make.sig(t)) for t in b["text"]]})
    return run


def _verified(similarity: float, shingle: int):
    """Rows sorted by block (key, part, sub), members first: every other row of a block is compared with its members unless they
    are connected already. Links of blocks as a forest; only the members of one block are held."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, block, members, root = _WordHash(), None, [], {}

        def find(i: int) -> int:
            root.setdefault(i, i)
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for b in batches:
            out = []
            for key, part, sub, node, comp, member, text in zip(b["key"], b["part"], b["sub"], b["node"], b["comp"], b["member"], b["text"]):
                if block != (key, part, sub):
                    block, members, root = (key, part, sub), [], {}
                grams = np.unique(shingles(text, words, shingle))
                if member:
                    members.append((node, comp, grams))
                    continue
                for other, theirs, held in members:
                    small, large = sorted((len(grams), len(held)))
                    if small < similarity * large or find(comp) == find(theirs):
                        continue
                    both = len(np.intersect1d(grams, held, assume_unique=True))
                    if both >= similarity * (small + large - both):
                        root[find(comp)] = find(theirs)
                        out.append((node, other))
            yield pd.DataFrame(out, columns=["u", "v"]).astype("int64")
    return run


def _compare(blocks: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links ``(u, v)`` of ``blocks`` (key, part, sub, node, comp, member)."""
    order = ["key", "part", "sub"]
    return (blocks.join(texts, "node").repartition(*order).sortWithinPartitions(*order, F.col("member").desc())
            .mapInPandas(_verified(similarity, shingle), "u long, v long"))


def _roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with ``comp``: the smallest node reachable."""
    roots = connected_components(edges).select("node", F.col("root").alias("comp"))
    return nodes.join(roots, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _cut(n: F.Column, size: int) -> F.Column:
    return F.ceil(n / F.lit(size)).cast("int")


def _all(parts: F.Column) -> F.Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _rest(held: DataFrame, edges: DataFrame) -> DataFrame:
    """Blocks of what the comparisons with the pivots leave open. Without its pivot a group is settled where one component is
    left. Else its rows outside the largest component are members, in parts of about ``GROUP``, and all its rows meet each part."""
    rows = materialise(_roots(held.filter("node <> pivot").select("key", "node"), edges), "minhash-rest")
    sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"))
    open_ = (sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("big"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps"),
                                      F.sum("mark").alias("mark")).filter("comps > 1")
             # bands that hold the same texts are one group
             .groupBy("n", "mark").agg(F.min(F.struct("key", "big")).alias("one"))
             .select("one.key", F.col("one.big.comp").alias("big"), _cut(F.col("n") - F.col("one.big.n"), GROUP).alias("parts"),
                     _cut(F.col("n"), MET).alias("subs")))
    rows = materialise(rows.join(open_, "key"), "minhash-open-groups")
    own = lambda parts, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(parts)).cast("int")
    members = rows.filter("comp <> big").select("key", own("parts", 1).alias("part"), _all(F.col("subs")).alias("sub"), "node", "comp",
                                                F.lit(True).alias("member"))
    met = rows.select("key", _all(F.col("parts")).alias("part"), own("subs", 2).alias("sub"), "node", "comp", F.lit(False).alias("member"))
    return members.unionByName(met)


def classes(texts: DataFrame, signed: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS) -> DataFrame:
    """``(node, class_id)`` of every distinct text, from its rows' ``signed`` (doc_id, node, fingerprint) and ``texts`` (node, text).

    Texts that share a signature band are a group. First all are compared with the group's pivot, its smallest node, in blocks
    of at most about ``MET`` texts; groups of near copies are settled by that, with one row per text and pivot. ``_rest`` then
    compares whatever is not connected, so no link is lost. Texts are read for members of groups only."""
    width = PERMUTATIONS * 4 // bands
    bits = [F.xxhash64(F.lit(i), F.substring("fingerprint", 1 + i * width, width)).alias(f"band{i}") for i in range(bands)]
    names = [f"band{i}" for i in range(bands)]
    nodes = materialise(signed.select("doc_id", "node", *bits).groupBy("node").agg(
        F.min("doc_id").alias("least"), *[F.min(c).alias(c) for c in names]), "minhash-nodes")
    pairs = nodes.select("node", F.explode(F.array(*names)).alias("key"))
    shared = pairs.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    held = materialise(pairs.join(shared.filter("pivot < last").select("key", "pivot"), "key"), "minhash-held")
    # a written table has a measured size: while it is small, Spark broadcasts it and texts outside groups are not shuffled
    wanted = materialise(held.select("node").distinct(), "minhash-wanted")
    mine = materialise(texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "minhash-candidates")
    links = held.filter("node <> pivot").select("pivot", "node").distinct()
    subs = links.groupBy("pivot").agg(_cut(F.count(F.lit(1)), MET).alias("subs"))
    met = links.join(subs, "pivot").select(F.col("pivot").alias("key"), F.lit(0).alias("part"), F.pmod(F.xxhash64("node"), F.col("subs")).cast("int").alias("sub"),
                                           "node", F.col("node").alias("comp"), F.lit(False).alias("member"))
    pivots = subs.select(F.col("pivot").alias("key"), F.lit(0).alias("part"), _all(F.col("subs")).alias("sub"), F.col("pivot").alias("node"),
                         F.col("pivot").alias("comp"), F.lit(True).alias("member"))
    first = materialise(_compare(met.unionByName(pivots), mine, shingle, similarity), "minhash-links")
    later = materialise(_compare(_rest(held, first), mine, shingle, similarity), "minhash-links")
    placed = _roots(nodes.select("node", "least"), first.unionByName(later))
    named = placed.groupBy("comp").agg(F.min("least").alias("class_id"))
    return placed.join(named, "comp").select("node", "class_id")


def _noded(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text")).withColumn("node", F.xxhash64("text", F.lit(7)))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS) -> DataFrame:
    """``(doc_id, class_id)`` per row: the smallest doc_id reachable over texts that share a signature
    band and whose shingle sets have a Jaccard similarity of ``similarity`` or more. Equal texts are one
    node, texts without a word are alike; null where no row of the class has an id."""
    texts = _noded(docs)
    signed = materialise(texts.mapInPandas(_signed(shingle), "doc_id long, node long, fingerprint string"), "minhash-signed")
    return signed.select("doc_id", "node").join(classes(texts.select("node", "text"), signed, shingle, similarity, bands), "node").select(
        "doc_id", "class_id")
