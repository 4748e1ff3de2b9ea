"""Quality from positive and unlabelled texts: non-negative unbiased risk.

Trusted positives are a bounded sample (``SAMPLE``) of labelled ids of quality 1, of equal weight however many rows
an id has; unlabelled text is all documents whatever their labels. Rows labelled 0 are never used as such. Texts become dense features: shares of character-class
trigrams (letters, capitals, digits, marks, blanks, line ends, others), and repetition measures of words and
lines. A first logistic model of positives against unlabelled text gives the class prior: the least ratio, over
score thresholds, of the unlabelled to the positive share above it. The final model minimises

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

by Newton steps; the risk without max() is convex, and a step that would make the second term negative is halved until
it is not, and is the last. Features are computed once, where the texts are, into a shared table. Every step, the moments
and the prior's score histogram are sums over all its rows, added up on the executors; only these sums reach the driver.

Null and empty texts have zero features and are scored as such; null doc_ids are scored like others; repeated
rows give a row each; extra columns are dropped; null labels are skipped; without trusted positives every
score is 0.5; an empty table gives an empty result; texts are read whole at any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise, text_col
from oddsframe.llm.toxicity_knn import sampled_labels

SAMPLE = 8_000  # trusted labelled ids, at most or nearly
STEPS, HALVINGS, TOLERANCE, RIDGE = 20, 8, 1e-5, 1e-3
LEAST, BINS = 0.2, 20_000  # share of positives above a threshold of the prior; score bins
CLASSES = 7
SLAB = 1 << 20  # characters whose classes are held at once


def _class_table() -> np.ndarray:
    table = np.full(0x250, 5, dtype=np.int64)
    for c in range(len(table)):
        x = chr(c)
        table[c] = (0 if x.islower() else 1 if x.isupper() else 2 if x.isdigit() else 3 if x == "\n"
                    else 4 if x.isspace() else 5)
    for x in ".,;:?'\"-()":
        table[ord(x)] = 6
    return table


_TABLE = _class_table()


def features(text: str) -> np.ndarray:
    grams = np.zeros(CLASSES ** 3)
    for at in range(0, len(text), SLAB):
        points = np.frombuffer(text[max(0, at - 2):at + SLAB].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = _TABLE[np.minimum(points, len(_TABLE) - 1)]
        grams += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES ** 3) if len(c) > 2 else 0
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n, m = len(words), len(lines)
    twins = sum(map(eq, words, words[1:])) / n if n else 0.0
    later = sum(map(eq, words, words[2:])) / n if n else 0.0
    new = len(set(words)) / n ** 0.85 if n else 0.0
    rest = [twins, later, new, 1 - len(set(lines)) / m if m else 0.0, np.log1p(n) / 10, np.log1p(len(text)) / 10,
            sum(map(len, words)) / n / 10 if n else 0.0, sum(len(w) == 1 for w in words) / n if n else 0.0]
    return np.concatenate((np.sqrt(grams / max(1.0, grams.sum())), rest)).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # the last one is the intercept
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weight[:-1] + self.weight[-1]
        return 1 / (1 + np.exp(-z.clip(-50, 50)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z.clip(-50, 50)))


def _least_ratio(a: np.ndarray, b: np.ndarray, n_p: float, n_u: float) -> float:
    """The least of b / a, the shares of unlabelled and positive rows above thresholds, each with two
    standard errors added."""
    err = 2 * np.sqrt(b * (1 - b) / n_u + a * (1 - a) / n_p)
    return float(np.clip(np.min((b + err) / a), 0.05, 0.99))


def class_prior(p: np.ndarray, u: np.ndarray, least: float = LEAST) -> float:
    """Share of positives in unlabelled rows from scores of both: the least upper bound
    ``P_U(s >= t) / P_P(s >= t)`` over thresholds that keep the share ``least`` of positives, each with two
    standard errors added."""
    t = np.quantile(p, np.linspace(0, 1 - least, 200))
    a = 1 - np.searchsorted(np.sort(p), t, side="left") / len(p)
    b = 1 - np.searchsorted(np.sort(u), t, side="left") / len(u)
    return _least_ratio(a, b, len(p), len(u))


def histogram_prior(p: np.ndarray, u: np.ndarray, least: float = LEAST) -> float:
    """``class_prior`` from how many rows of both lie in each of the same score bins."""
    a, b = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (p, u))
    at = np.unique(np.maximum(np.searchsorted(-a, -(1 - np.linspace(0, 1 - least, 200)), side="right") - 1, 0))
    return _least_ratio(a[at], b[at], p.sum(), u.sum())


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"p": b["p"], "x": [features(t).tobytes() for t in b["text"]]})


def _summed(rows: DataFrame, partial) -> list[np.ndarray]:
    """Sums over all rows of the arrays that ``partial(x, p)`` gives for blocks of rows (features, weights as
    trusted positives). Each task adds up its own; vectors are then added by their number on the executors, so
    the driver receives one sum whatever the number of tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[np.ndarray] = []
        for b in batches:
            p = b.column("p").to_numpy(zero_copy_only=False)
            if len(p):
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), dtype=np.float32).reshape(len(p), -1)
                part = partial(x.astype(np.float64), p)
                total = [m + n for m, n in zip(total, part)] if total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                              pa.array([t.tobytes() for t in total], pa.binary())], names=["i", "v"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        v = np.sum([np.frombuffer(x) for x in sorted(map(bytes, part["v"]))], axis=0)
        return pd.DataFrame({"i": part["i"].iloc[:1].astype("int32"), "v": [v.tobytes()]})

    got = rows.mapInArrow(run, "i int, v binary").groupBy("i").applyInPandas(add, "i int, v binary").collect()
    return [np.frombuffer(bytes(r["v"])) for r in sorted(got, key=lambda r: r["i"])]


def _moments(x: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
    return [x.sum(axis=0), (x * x).sum(axis=0), p @ x, p @ (x * x), np.array([float(len(p)), p.sum()])]


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack((((x - mean) / scale).clip(-8, 8), np.ones(len(x))))


def _minimise(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, n_u: float, n_p: float, prior: float | None) -> np.ndarray:
    """Newton steps on the risk over all rows or, without a prior, on positives against unlabelled rows. Both
    are convex; a step that makes the risk rise, or the non-negative term negative, is halved."""
    share_p = 1.0 if prior is None else 0.0  # positives bend only the first of both

    def at(w: np.ndarray):
        def partial(x: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
            x = _standard(x, mean, scale)
            z = x @ w
            s, up, down = _sigmoid(z), np.logaddexp(0, z), np.logaddexp(0, -z)
            h = (x * (s * (1 - s) * (1 / n_u + share_p * p / n_p))[:, None]).T @ x
            return [*h, s @ x, (p * s) @ x, p @ x, np.array([up.sum(), p @ up, p @ down])]

        got = _summed(rows, partial)
        h, (su, sp, one, loss) = np.array(got[:len(w)]), got[len(w):]
        lu, lp, lm = loss[0] / n_u, loss[1] / n_p, loss[2] / n_p
        ridge = RIDGE * np.append(w[:-1], 0)
        if prior is None:
            risk, g, term = lm + lu, su / n_u - (one - sp) / n_p, 0.0
        else:  # loss(+) - loss(-) is -z
            term = lu - prior * lp
            risk, g = prior * lm + term, su / n_u - prior * one / n_p
        return risk + ridge @ w / 2, g + ridge, h + np.diag(np.append(np.full(len(w) - 1, RIDGE), 1e-9)), term

    w = np.zeros(len(mean) + 1)
    risk, g, h, term = at(w)
    for _ in range(STEPS):
        move, held = np.linalg.solve(h, g), False
        gain = float(g @ move)
        for halved in range(HALVINGS):
            new = w - move / 2 ** halved
            found = at(new)
            if found[0] <= risk and found[3] >= 0:
                break
            held |= found[3] < 0
        else:
            return w
        w, (risk, g, h, term) = new, found
        if held or gain < TOLERANCE:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from ``labels`` (doc_id, quality), which the caller has cut to the rows that may be learned from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col().alias("text"))
    trusted = sampled_labels(labels.filter(F.col("quality") == 1), "quality", sample).select("doc_id")
    # the rows of a repeated id share the weight of one trusted row
    times = (texts.select("doc_id").join(F.broadcast(trusted), "doc_id").groupBy("doc_id")
             .agg((1 / F.count(F.lit(1))).alias("p")))
    rows = materialise(texts.join(F.broadcast(times), "doc_id", "left").select("text", F.coalesce("p", F.lit(0.0)).alias("p"))
                       .mapInPandas(_featured, "p double, x binary"), "quality-features")
    sums = _summed(rows, _moments)
    if not sums or not sums[4][1]:
        return None
    n_u, n_p = sums[4]
    mean = (sums[0] / n_u + sums[2] / n_p) / 2
    scale = np.sqrt(np.maximum((sums[1] / n_u + sums[3] / n_p) / 2 - mean ** 2, 0)) + 1e-3
    first = _minimise(rows, mean, scale, n_u, n_p, None)

    def bins(x: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
        z = (_standard(x, mean, scale) @ first).clip(-50, 50)
        at = np.minimum(((z + 50) * (BINS / 100)).astype(np.int64), BINS - 1)
        return [np.bincount(at, p, BINS), np.bincount(at, minlength=BINS).astype(np.float64)]

    prior = histogram_prior(*_summed(rows, bins))
    return Model(mean, scale, _minimise(rows, mean, scale, n_u, n_p, prior), prior)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with a column ``_quality``: the probability of quality 1."""
    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array([features(t) for t in part]).reshape(len(part), -1)
            yield pd.Series(model.score(x) if model is not None and len(part) else np.full(len(part), 0.5))

    return docs.withColumn("_quality", rate(text_col(text)))
