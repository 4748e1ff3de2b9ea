"""Toxicity from the nearest labelled examples under exact TF-IDF cosine, with a block-max index.

Terms are words and pieces of words (every run of 4 to 6 letters that starts a word, every inner run of
5), so that inflected forms meet. ``VOCABULARY`` terms that tell the labels apart best (by the z value of
their document shares) are kept from a bounded sample of labelled rows; their document frequencies are
counted over all documents. One more term, of fixed weight, counts a text's other words, so that a single
hit in a long text is unlike many. Examples are the sample's vectors; equal vectors are one example with its
labels counted.

Index: examples are ordered by their heaviest term and cut in blocks; per term and block the largest weight
is kept. A query's bound for a block is the sum over its terms of weight times block maximum. Blocks are
scored exactly in descending order of bound until the k-th best cosine reaches the next bound, so the
nearest examples are exact. They vote with weight cosine squared; votes are calibrated by isotonic
regression on the examples' own leave-one-out votes. Texts without any kept term get the toxic share
of such examples. The index is broadcast: its size is bounded by the sample and the vocabulary.

Null and empty texts have no terms and are scored as such. Null doc_ids are scored like others (never
labelled); repeated rows give a row each; extra columns are dropped; labels that are null are skipped, and
of several labels of an id the largest counts; without labelled rows every score is 0; an empty table gives an
empty result; texts are read whole at any length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import text_col
from oddsframe.llm.token_counts import expand

SAMPLE = 20_000  # labelled rows at most, or nearly, that are examples
VOCABULARY = 4_096
MIN_EXAMPLES, MIN_Z = 4, 4.0
NEAREST = 15
BACKGROUND = 8.0  # weight of the term that stands for all words without kept terms
BLOCK = 64
WORDS_MAX = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> set[str]:
    out = {"=" + word}
    out.update("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)
    out.update(word[i:i + 5] for i in range(1, len(word) - 4))
    return out


class _Terms:
    """The kept terms of words. Few words have any, so those that have are looked up by set operations on a
    text's distinct words, and only words not met before are cut into pieces."""

    def __init__(self, number: dict[str, int]) -> None:
        self.number = number
        self.met: set[str] = set()
        self.hits: dict[str, tuple[int, ...]] = {}

    def learn(self, words: set[str]) -> None:
        get = self.number.get
        for word in words - self.met:
            n = len(word)
            found = {get("=" + word), *[get("^" + word[:k]) for k in (4, 5, 6) if n >= k],
                     *[get(word[i:i + 5]) for i in range(1, n - 4)]}
            found.discard(None)
            if found:
                self.hits[word] = tuple(sorted(found))
        if len(self.met) >= WORDS_MAX:
            self.met.clear()
            self.hits = {w: self.hits[w] for w in words & self.hits.keys()}
        self.met |= words

    def held(self, text: str) -> set[int]:
        """Numbers of the kept terms in ``text``."""
        words = set(_WORD.findall(text.lower()))
        self.learn(words)
        return set().union(*[self.hits[w] for w in words & self.hits.keys()])

    def counts(self, text: str) -> Counter:
        words = Counter(_WORD.findall(text.lower()))
        self.learn(set(words))
        out: Counter = Counter()
        other = words.total()
        for word in words.keys() & self.hits.keys():
            n = words[word]
            other -= n
            for t in self.hits[word]:
                out[t] += n
        if out and other:
            out[len(self.number)] = other
        return out


@dataclass
class Model:
    number: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))  # a row id per example
    rows: np.ndarray = field(default_factory=lambda: np.empty(0))  # rows per example
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))  # toxic rows per example
    example: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))  # postings, by term
    weight: np.ndarray = field(default_factory=lambda: np.empty(0))
    edge: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), dtype=np.int64))  # term x block -> postings
    most: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # term x block -> largest weight
    bare: float = 0.0  # share of toxic rows among examples without a term
    steps: np.ndarray = field(default_factory=lambda: np.array([0.0]))  # votes ...
    values: np.ndarray = field(default_factory=lambda: np.array([0.0]))  # ... and what they mean

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(counts), dtype=np.int64)
        w = (1 + np.log(np.array([counts[x] for x in t.tolist()], dtype=float))) * self.idf[t]
        norm = math.sqrt(float(w @ w))
        return (t, w / norm) if norm > 0 else (t[:0], w[:0])

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEAREST, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines, exactly; ``without`` is left out."""
        bound = w @ self.most[t]
        blocks = np.argsort(-bound, kind="stable")
        cosine, done, step = np.zeros(len(self.rows)), 0, 4
        kth = 0.0
        while done < len(blocks) and bound[blocks[done]] > kth:
            now = blocks[done:done + step]
            a, n = self.edge[t][:, now], (self.edge[t][:, now + 1] - self.edge[t][:, now])
            at = expand(a.ravel(), n.ravel())
            np.add.at(cosine, self.example[at], np.repeat(np.repeat(w, len(now)), n.ravel()) * self.weight[at])
            done, step = done + step, step * 2
            if without >= 0:
                cosine[without] = 0
            if len(cosine) > k:
                kth = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
        best = np.argsort(-cosine, kind="stable")[:k]
        best = best[cosine[best] > 0]
        return best, cosine[best]

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        w = cosine ** 2 * self.rows[best]
        return float((w * self.toxic[best] / self.rows[best]).sum() / w.sum())

    def score(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        """Calibrated score, and row ids of the examples that gave it."""
        t, w = self.vector(counts)
        best, cosine = self.nearest(t, w) if len(t) and len(self.rows) else (np.empty(0, dtype=np.int64), np.empty(0))
        if not len(best):
            return self.bare, []
        return float(np.interp(self.vote(best, cosine), self.steps, self.values)), self.ids[best].tolist()


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of y on x by pooling adjacent violators; (places, values)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted sum, first x, last x
    for a, b, c in zip(x[order], y[order], w[order]):
        if pools and pools[-1][3] == a:
            pools[-1][0] += c
            pools[-1][1] += c * b
        else:
            pools.append([c, c * b, a, a])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1][0] += last[0]
            pools[-1][1] += last[1]
            pools[-1][3] = last[3]
    return (np.array([p for pool in pools for p in pool[2:]]),
            np.array([pool[1] / pool[0] for pool in pools for _ in (0, 1)]))


def _index(model: Model, vectors: list[tuple[tuple, int, int, int]]) -> None:
    """Fill the model's index with examples ``((terms, counts), row id, rows, toxic rows)``."""
    with_terms = [(model.vector(dict(zip(*v))), i, n, y) for v, i, n, y in vectors if v[0]]
    none = [(n, y) for v, _, n, y in vectors if not v[0]]
    model.bare = (sum(y for _, y in none) / sum(n for n, _ in none)) if none else 0.0
    with_terms.sort(key=lambda x: (int(x[0][0][np.argmax(x[0][1])]), x[1]))
    v, m = len(model.idf), len(with_terms)
    model.ids = np.array([x[1] for x in with_terms], dtype=np.int64)
    model.rows, model.toxic = (np.array([x[c] for x in with_terms], dtype=float) for c in (2, 3))
    if not m:
        return
    term = np.concatenate([x[0][0] for x in with_terms])
    example = np.repeat(np.arange(m), [len(x[0][0]) for x in with_terms])
    weight = np.concatenate([x[0][1] for x in with_terms])
    order = np.lexsort((example, term))
    term, model.example, model.weight = term[order], example[order], weight[order]
    blocks = -(-m // BLOCK)
    cell = term * blocks + model.example // BLOCK
    full = np.searchsorted(cell, np.arange(v * blocks + 1))
    model.edge = np.concatenate((full[:-1].reshape(v, blocks), full[blocks::blocks].reshape(v, 1)), axis=1)
    model.most = np.zeros((v, blocks))
    np.maximum.at(model.most.ravel(), cell, model.weight)
    votes, share, rows = [], [], []
    for i, ((t, w), _, n, y) in enumerate(with_terms):
        best, cosine = model.nearest(t, w, without=i)
        if len(best):
            votes.append(model.vote(best, cosine))
            share.append(y / n)
            rows.append(n)
    if votes:
        model.steps, model.values = _isotonic(np.array(votes), np.array(share), np.array(rows, dtype=float))


def sampled_labels(labels: DataFrame, column: str, sample: int) -> DataFrame:
    """``(doc_id, y)`` of a sample of about ``sample`` labelled ids at most, by a hash of the id."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("y")))
    n = one.count()
    if n <= sample:
        return one
    grain = 1_000_000
    return one.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(grain)) < int(grain * sample / n))


def _sample_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        seen: Counter = Counter()
        toxic: Counter = Counter()
        for text, y in zip(b["text"], b["y"]):
            found = set().union(*map(terms_of, set(_WORD.findall(text.lower()))))
            seen.update(found)
            if y:
                toxic.update(found)
        yield pd.DataFrame({"term": list(seen), "n": list(seen.values()), "pos": [toxic[t] for t in seen]})


def _sparse(number: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Terms(number)
        for b in batches:
            found = [sorted(known.counts(t).items()) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "terms": [[t for t, _ in f] for f in found],
                                "counts": [[n for _, n in f] for f in found]})
    return run


def _frequencies(number: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen, docs = _Terms(number), Counter(), 0
        for b in batches:
            docs += len(b)
            for text in b["text"]:
                seen.update(known.held(text))
        yield pd.DataFrame({"term": [-1, *seen], "n": [docs, *seen.values()]})
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """Learn from ``labels`` (doc_id, toxic), which the caller has cut to the rows that may be learned from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text"))
    chosen = sampled_labels(labels, "toxic", sample)
    # equal texts are one row of the sample, lest a group of copies make its words look telling
    train = (texts.join(F.broadcast(chosen), "doc_id")
             .groupBy(F.xxhash64("text", F.lit(3)).alias("same"), "y").agg(F.min("doc_id").alias("doc_id"))
             .select("doc_id", "y"))
    train = texts.join(F.broadcast(train), "doc_id").dropDuplicates(["doc_id"])
    model = Model()
    total = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n, pos = int(total[0]), int(total[1])
    if not n:
        return model
    neg = n - pos
    shares = train.mapInPandas(_sample_terms, "term string, n long, pos long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    p1, p0 = (F.col("pos") + 0.5) / (pos + 1.0), (F.col("n") - F.col("pos") + 0.5) / (neg + 1.0)
    z = (p1 - p0) / F.sqrt(p1 * (1 - p1) / (pos + 1.0) + p0 * (1 - p0) / (neg + 1.0))
    kept = (shares.filter(F.col("n") >= MIN_EXAMPLES).filter(p1 > 2 * p0).select("term", z.alias("z"))
            .filter(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "term").limit(vocabulary).collect())
    model.number = {r["term"]: i for i, r in enumerate(kept)}
    df = {r["term"]: r["n"] for r in texts.select("text").mapInPandas(
        _frequencies(model.number), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    model.idf = np.array([math.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(len(kept))] + [BACKGROUND])
    examples: dict[tuple, list[int]] = {}
    for r in train.mapInPandas(_sparse(model.number), "doc_id long, y int, terms array<int>, counts array<int>").collect():
        e = examples.setdefault((tuple(r["terms"]), tuple(r["counts"])), [r["doc_id"], 0, 0])
        e[0], e[1], e[2] = min(e[0], r["doc_id"]), e[1] + 1, e[2] + r["y"]
    _index(model, sorted(((v, *e) for v, e in examples.items()), key=lambda x: x[1]))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``_toxicity``: struct of ``score`` and ``evidence`` (ids of the examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence array<long>")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        known, seen = _Terms(m.number), {}
        for part in parts:
            out = []
            for t in part:
                counts = known.counts(t)
                key = tuple(sorted(counts.items()))
                if key not in seen:
                    if len(seen) >= WORDS_MAX:
                        seen.clear()
                    seen[key] = m.score(counts)
                out.append(seen[key])
            yield pd.DataFrame(out, columns=["score", "evidence"])

    return docs.withColumn("_toxicity", rate(text_col(text)))
