"""Rows of a group packed into blocks: one row per at most ``BLOCK`` rows of a group, a binary column per column.

Fits that read their rows many times read blocks: a task meets a few groups, one after the other, works on whole blocks with numpy and
passes on one partial sum per group. Rows are dealt by ranges of (group, row), so a group with a third of all rows is spread over a third of the
tasks. What a pass needs from the last one (a row per group: splits, trees, coefficients) is joined to the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.session import stored

BLOCK = 8192
# of the columns of a block: numpy type, Spark type
NUMBERS = {"event_id": ("<i8", "long"), "y": ("i1", "tinyint"), "fold": ("i1", "tinyint")}
WIDE = {"x": "<f8", "z": "<f8", "bins": "u1"}


def key_schema(df: DataFrame, keys: list[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"{k} {types[k]}" for k in keys)


def pack(rows: DataFrame, keys: list[str], numbers: list[str], wide: list[str]) -> DataFrame:
    """``(*keys, n, d, *numbers, *wide)``: blocks of the rows, written. A ``wide`` column is an array of ``d`` values, in a block a matrix of d
    rows; missing values are -inf, so below every edge. Rows with a null key are left out."""
    chosen = rows.dropna(subset=keys).select(*keys, *[F.col(c).cast(NUMBERS[c][1]) for c in numbers], *wide)
    placed = chosen.repartitionByRange(*keys, *numbers[:1]).sortWithinPartitions(*keys)
    schema = ", ".join([key_schema(rows, keys), "n int, d int", *[f"{c} binary" for c in [*numbers, *wide]]])
    return placed.mapInArrow(_pack(len(keys), numbers, wide), schema).transform(stored, "blocks")


def _pack(many_keys: int, numbers: list[str], wide: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, dtype=bool)
            new[::BLOCK] = True
            for i in range(many_keys):
                v = batch.column(i).to_numpy(zero_copy_only=False)
                new[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], n)
            found: dict[str, list] = {c: [] for c in ["n", "d", *numbers, *wide]}
            found["n"], found["d"] = (ends - starts).tolist(), [0] * len(starts)
            for c in numbers:
                v = batch.column(c).to_numpy(zero_copy_only=False).astype(NUMBERS[c][0])
                found[c] = [v[a:b].tobytes() for a, b in zip(starts, ends)]
            for c in wide:
                lists = batch.column(c)
                at, v = lists.offsets.to_numpy(), lists.values
                v = (v.fill_null(-np.inf) if v.null_count else v).to_numpy(zero_copy_only=False)
                for j, (a, b) in enumerate(zip(starts, ends)):
                    width = np.diff(at[a:b + 1])
                    if (width != width[0]).any():
                        raise ValueError(f"{c}: rows of a group differ in length")
                    m = v[at[a]:at[b]].reshape(b - a, width[0]).T
                    found["d"][j] = int(width[0])
                    found[c].append(np.ascontiguousarray(m, dtype=WIDE[c]).tobytes())
            columns = [batch.column(i).take(pa.array(starts)) for i in range(many_keys)]
            columns += [pa.array(found[c], pa.int32()) for c in ("n", "d")] + [pa.array(found[c], pa.binary()) for c in [*numbers, *wide]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:many_keys], *found])
    return run


class Block:
    """A row of a batch: the group's key, and the columns as arrays where they are asked for."""

    def __init__(self, columns: dict, row: int, keys: list[str]):
        self.columns, self.row = columns, row
        self.key = tuple(columns[k][row].as_py() for k in keys)

    def types(self, keys: list[str]) -> dict[str, pa.DataType]:
        return {k: self.columns[k].type for k in keys}

    def value(self, column: str):
        return self.columns[column][self.row].as_py()

    def array(self, column: str) -> np.ndarray:
        return np.frombuffer(self.columns[column][self.row].as_buffer(), dtype=(NUMBERS[column][0] if column in NUMBERS else WIDE[column]))

    def matrix(self, column: str) -> np.ndarray:
        return self.array(column).reshape(self.value("d"), self.value("n"))


def each(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[Block]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        for row in range(batch.num_rows):
            yield Block(columns, row, keys)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[Block]]]:
    """Runs of blocks of one key, each to be read to its end before the next."""
    blocks = each(batches, keys)
    ahead = next(blocks, None)

    def run(key):
        nonlocal ahead
        while ahead is not None and ahead.key == key:
            block, ahead = ahead, None
            yield block
            ahead = next(blocks, None)
    while ahead is not None:
        yield ahead.key, run(ahead.key)


def batch_of(types: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    """A batch from tuples, column by column."""
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


def brought_together(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Partial sums of a key in one task, one after the other: a row per task that met the group, whatever its rows."""
    return parts.repartition(*keys).sortWithinPartitions(*keys)
