"""Whitening by an incremental eigendecomposition of the covariance.

Entries become ``floor(scale * c) + offset``. A task keeps, per vector length, a row count, a mean, and the spectrum (eigenvalues
and unit vectors) of the centred scatter of its rows so far. A block of rows is centred on its own mean and brought to its
triangular factor, whose at most d rows have the block's scatter; each is applied as a rank-one update, and the shift between
the block's mean and the task's is one more. A rank-one update of a spectrum is a secular equation: entries of
the update that are negligible, and equal eigenvalues (turned into one by a rotation), are deflated; the roots of the
rest lie between neighbouring eigenvalues and are found by bisection from the nearer one, and the update's entries are recomputed
from the roots, so that the vectors stay orthogonal to working precision. Spectra of tasks are combined in a
tree, ``FAN`` at a time, by the same updates: one per eigenpair of the smaller spectrum, one for the shift of means.

A last pass over all rows sums the covariance in the basis found (Rayleigh-Ritz); its small eigenproblem turns the basis into
components accurate to double precision. Sums over rows are exact whole numbers.

Vectors that are null, empty, or hold null or non-finite entries take no part. Vectors of different lengths are whitened apart,
each length with its own count, sums and components. Entries beyond 2^62 once scaled are held there. ``deviation`` is null
where it passes 64 bits. A component whose eigenvalue is zero to rounding (fewer distinct rows than dimensions) has no
whitened value: null, and it does not enter ``identity_error``. Repeated rows count as often as they occur; a null id is kept;
an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise

FAN = 16                  # spectra combined by one task
TINY = 8 * np.finfo(float).eps
HELD = float(2 ** 62)
STATE = "d int, n long, mean array<double>, values array<double>, vectors array<double>"


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x) = 0 for rising, distinct ``d`` and positive ``z2``: the index of the nearer
    pole of each, and its distance from that pole."""
    m = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = upper - d
    # sign at the middle of each gap says which pole is nearer; distances from a pole keep their digits
    middle = gap / 2
    value = 1 + (z2 / ((d - d[:, None]) - middle[:, None])).sum(axis=1)
    left = (value >= 0) | (np.arange(m) == m - 1)
    pole = np.where(left, np.arange(m), np.arange(m) + 1)
    low = np.where(value >= 0, 0.0, middle) if m else middle
    low, high = np.where(left, low, -middle), np.where(left, np.where(value >= 0, middle, gap), 0.0)
    far = d - d[pole][:, None]
    for _ in range(200):
        mid = (low + high) / 2
        done = (mid == low) | (mid == high)
        if done.all():
            break
        with np.errstate(divide="ignore", over="ignore"):
            f = 1 + (z2 / (far - mid[:, None])).sum(axis=1)
        low, high = np.where(f < 0, mid, low), np.where(f < 0, high, mid)
    # the end away from the pole: a distance is never zero
    return pole, np.where(left, high, low)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors diag(values) vectors^T + v v^T``; eigenvalues rise."""
    z = vectors.T @ v
    size = float(z @ z)
    if not size > 0:
        return values, vectors
    scale = max(float(np.abs(values).max()), size)
    values, vectors, z = values.copy(), vectors.copy(), z.copy()
    # deflation: an entry too small to matter, then neighbours too close to matter
    keep = np.abs(z) * np.sqrt(size) > TINY * scale
    last = -1
    for i in np.flatnonzero(keep):
        if last >= 0:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            if (values[i] - values[last]) * abs(c * s) <= TINY * scale:
                a, b = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
                low, high = values[last], values[i]
                values[last], values[i] = c * c * low + s * s * high, s * s * low + c * c * high
                z[last], z[i], keep[last] = 0.0, r, False
        last = i
    at = np.flatnonzero(keep)
    at = at[np.argsort(values[at], kind="stable")]
    d, w = values[at], z[at]
    if len(at) == 1:
        values[at[0]] = d[0] + w[0] ** 2
    elif len(at):
        pole, away = _roots(d, w ** 2)
        # distance[i, j] = d_j - root_i, formed from the pole so that it keeps its digits
        distance = (d - d[pole][:, None]) - away[:, None]
        m = len(d)
        # the update that has exactly these roots
        ratio = -distance.copy()
        for j in range(m):
            others = d - d[j]
            others[j] = 1.0
            ratio[:, j] = ratio[:, j] / np.where(np.arange(m) == j, 1.0, others)
        w = np.sign(w) * np.sqrt(np.abs(np.prod(ratio, axis=0)))
        turned = w / distance
        turned /= np.linalg.norm(turned, axis=1)[:, None]
        vectors[:, at] = vectors[:, at] @ turned.T
        values[at] = d[pole] + away
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and spectrum of the centred scatter of the rows seen."""

    def __init__(self, d: int, n: int = 0, mean=None, values=None, vectors=None) -> None:
        self.n = n
        self.mean = np.zeros(d) if mean is None else np.array(mean, dtype=np.float64)
        self.values = np.zeros(d) if values is None else np.array(values, dtype=np.float64)
        self.vectors = np.eye(d) if vectors is None else np.array(vectors, dtype=np.float64).reshape(d, d)

    def update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        """Take in ``n`` more rows with the given mean, but for their scatter about it."""
        total = self.n + n
        if self.n:
            self.update(np.sqrt(self.n * (n / total)) * (mean - self.mean))
        self.mean = self.mean + (mean - self.mean) * (n / total)
        self.n = total

    def add(self, block: np.ndarray) -> None:
        mean = block.mean(axis=0)
        for row in np.linalg.qr(block - mean, mode="r"):
            self.update(row)
        self._shift(len(block), mean)

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        self._shift(other.n, other.mean)

    def row(self) -> tuple:
        return len(self.mean), self.n, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()


def _rows(states: list[Spectrum]) -> pd.DataFrame:
    return pd.DataFrame([s.row() for s in states], columns=["d", "n", "mean", "values", "vectors"])


def _blocks(batches: Iterator[pd.DataFrame], column: str = "x") -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for pdf in batches:
        for d, part in pdf.groupby("d"):
            yield int(d), part, np.stack(part[column].to_list())


def _spectra(offset: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, Spectrum] = {}
        for d, _, x in _blocks(batches):
            # the offset cancels in every covariance; taken off as a whole number it costs no digits
            found.setdefault(d, Spectrum(d)).add((x - offset).astype(np.float64))
        if found:
            yield _rows(list(found.values()))
    return run


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    states = [Spectrum(r.d, r.n, r.mean, r.values, r.vectors) for r in pdf.sort_values("n").itertuples(index=False, name="State")]
    whole = states.pop()
    for s in states:
        whole.merge(s)
    return _rows([whole])


def spectra(x: DataFrame, offset: int) -> DataFrame:
    """One spectrum per vector length, combined in a tree of ``FAN`` spectra a task."""
    found = materialise(x.mapInPandas(_spectra(offset), STATE), "whitening-spectra")
    while found.groupBy("d").count().filter("count > 1").limit(1).count():
        groups = -(-found.count() // FAN)
        dealt = found.withColumn("group", F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(groups)))
        found = materialise(dealt.groupBy("d", "group").applyInPandas(_combine, STATE), "whitening-spectra")
    return found


class Basis:
    """What every task of the last passes needs for one vector length; its size is d * d numbers."""

    def __init__(self, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray | None = None) -> None:
        self.n, self.sums, self.vectors, self.values = n, sums, vectors, values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole and fractional part of the mean apart, so that no digit of the difference is lost."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S)^2, exactly; None beyond 64 bits."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        near = x - whole   # n * x - S = n * (x - whole) - rest
        far = (np.abs(near).max(axis=1).astype(np.float64) + 1) * self.n
        safe = x.shape[1] * far ** 2 < 2.0 ** 62
        with np.errstate(over="ignore"):
            out = ((near * self.n - rest) ** 2).sum(axis=1).astype(object)
        for i in np.flatnonzero(~safe):
            total = sum((self.n * int(a) - s) ** 2 for a, s in zip(x[i], self.sums))
            out[i] = total if total < 2 ** 63 else None
        return out

    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.values > max(self.values.max(), 0.0) * len(self.values) * 1e-13

    def whitened(self, x: np.ndarray, count: int) -> np.ndarray:
        k = min(count, len(self.values))
        on = self.usable()[:k]
        return (self.centred(x) @ self.vectors[:, :k]) / np.where(on, np.sqrt(np.where(on, self.values[:k], 1.0)), np.nan)


def _moments(project):
    """Per task and length the sums of p and p p^T over the rows' projections p."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, list] = {}
        for d, _, x in _blocks(batches):
            p = project(d, x)
            have = found.setdefault(d, [0.0, 0.0])
            have[0], have[1] = have[0] + p.sum(axis=0), have[1] + p.T @ p
        rows = [(d, i, np.append(second[i], first[i]).tolist()) for d, (first, second) in found.items() for i in range(len(first))]
        yield pd.DataFrame(rows, columns=["d", "line", "sums"])
    return run


def _second_moments(x: DataFrame, project) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sums over all rows by vector length; a small matrix per length reaches the driver."""
    lines = (x.mapInPandas(_moments(project), "d int, line int, sums array<double>")
             .select("d", "line", F.posexplode("sums").alias("at", "value"))
             .groupBy("d", "line", "at").agg(F.sum("value").alias("value")).collect())
    found = {}
    for d in {r.d for r in lines}:
        mine = [r for r in lines if r.d == d]
        k = max(r.line for r in mine) + 1
        table = np.zeros((k, k + 1))
        for r in mine:
            table[r.line, r["at"]] = r.value
        found[d] = table[:, k], table[:, :k]
    return found


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100000, vec: str = "embedding",
           key: str = "vec_id") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every row that takes part and each
    component up to ``components``."""
    fit = vectors.filter(F.col(vec).isNotNull() & (F.size(vec) > 0)).filter(
        F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))))
    held = lambda c: F.least(F.greatest(c.cast("double") * F.lit(float(scale)), F.lit(-HELD)), F.lit(HELD))
    x = materialise(fit.select(F.col(key).cast("long").alias("vec_id"), F.size(vec).alias("d"),
                               F.transform(vec, lambda c: F.floor(held(c)) + F.lit(offset)).alias("x")), "whitening-rows")
    sums = (x.select("d", F.posexplode("x").alias("at", "value")).groupBy("d", "at")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect())  # one row a dimension
    basis: dict[int, Basis] = {}
    for r in spectra(x, offset).collect():   # one row per vector length
        mine = sorted((t["at"], int(t.s)) for t in sums if t.d == r.d)
        basis[r.d] = Basis(r.n, [s for _, s in mine], np.array(r.vectors).reshape(r.d, r.d))
    # Rayleigh-Ritz: the covariance in the basis found, and its own small eigenproblem
    for d, (first, second) in _second_moments(x, lambda d, rows: basis[d].centred(rows) @ basis[d].vectors).items():
        b = basis[d]
        h = second / b.n - np.outer(first / b.n, first / b.n)
        values, turn = np.linalg.eigh((h + h.T) / 2)
        basis[d] = Basis(b.n, b.sums, b.vectors @ turn[:, ::-1], np.maximum(values[::-1], 0.0))
    trace = {d: float(b.values.sum()) for d, b in basis.items()}
    error: dict[int, float | None] = {}
    for d, (first, second) in _second_moments(x, lambda d, rows: basis[d].whitened(rows, components)).items():
        n = basis[d].n
        off = np.abs(second / n - np.outer(first / n, first / n) - np.eye(len(first)))
        error[d] = float(np.nanmax(off)) if np.isfinite(off).any() else None

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d, part, rows in _blocks(batches):
            b = basis[d]
            k = min(components, d)
            w = b.whitened(rows, components)
            yield pd.DataFrame({
                "vec_id": part["vec_id"].astype("Int64").repeat(k).to_numpy(dtype=object, na_value=None),
                "component": np.tile(np.arange(1, k + 1), len(part)), "n": b.n,
                "deviation": np.repeat(b.deviations(rows), k),
                "whitened": pd.array([None if np.isnan(v) else v for v in w.ravel()], dtype="object"),
                "explained": np.tile(b.values[:k] / trace[d] if trace[d] > 0 else np.zeros(k), len(part)),
                "identity_error": error[d]})

    return x.mapInPandas(emit, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                               "identity_error double")
