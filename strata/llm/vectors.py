"""Integer vectors: rows of an embedding table scaled and rounded down, scored against bounded blocks of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import written

#: Numbers in a wave of queries, 64 added for each query; what is broadcast at once is eight bytes for each.
WAVE_NUMBERS = 1_000_000
#: Queries and vectors scored at a time in a task.
QUERY_BLOCK, ROW_BLOCK = 512, 2048
#: Doubles add integers exactly up to here.
EXACT = 2.0 ** 53
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1


def integer_rows(batch: pa.RecordBatch, vector: str, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable rows, and their vectors ``floor(scale * x)`` as doubles; shorter vectors end in zeros.

    A row is usable if its vector is there and all its components are there and finite.
    """
    column = batch.column(vector)
    rows = column.filter(pc.is_valid(column))
    at = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rows.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(over="ignore"):
        flat = np.floor(flat * scale)
    width = int(lengths.max(initial=0))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    full = np.zeros((len(lengths), width))
    full[owner, place] = flat
    fine = np.isfinite(full).all(axis=1)
    return at[fine], full[fine]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of all pairs, exact; beyond 64 bits the nearest long."""
    width = min(queries.shape[1], rows.shape[1])
    left, right = queries[:, :width], rows[:, :width]
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    if np.abs(left).max() * np.abs(right).max() * width < EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in right]
    exact = [[min(max(sum(a * b for a, b in zip(query, row)), LEAST), MOST) for row in whole]
             for query in ([int(x) for x in row] for row in left)]
    return np.array(exact, np.int64).reshape(len(left), len(right))


def pair_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of rows that stand side by side."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if not left.size:
        return np.zeros(len(left), np.int64)
    if np.abs(left).max() * np.abs(right).max() * width < EXACT:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    return np.array([min(max(sum(int(a) * int(b) for a, b in zip(x, y)), LEAST), MOST) for x, y in zip(left, right)], np.int64)


def waves(queries: DataFrame, numbers: int = WAVE_NUMBERS) -> Iterator[pa.RecordBatch]:
    """The rows of ``queries`` (a column ``v`` of arrays among them) in waves of about ``numbers`` components.

    Only one wave is on the driver at a time. Rows are dealt to waves by their place in what was written, so
    repeated ones spread like any others.
    """
    total = queries.agg(F.sum(F.size("v") + F.lit(64)).alias("n")).first()["n"] or 0
    count = -(-total // numbers)
    if count > 1:
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).alias("_wave")
        queries = written(queries.select("*", place), "query-waves")
    for wave in range(count):
        chosen = queries.where(F.col("_wave") == wave).drop("_wave") if count > 1 else queries
        yield from chosen.toArrow().combine_chunks().to_batches()[:1]


class Best:
    """The ``k`` highest scores of every number, ties to the smaller vec_id, from triples that arrive in blocks."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [np.zeros((0, 3), np.int64)], 0

    def add(self, number: np.ndarray, vec_id: np.ndarray, score: np.ndarray, most: int = 200_000) -> None:
        if len(number):
            self.held.append(np.stack([number, vec_id, score], axis=1))
            self.size += len(number)
        if self.size > most:
            self.held, self.size = [self.rows()], 0

    def rows(self) -> np.ndarray:
        """``number, vec_id, score`` by number and rank."""
        rows = np.concatenate(self.held)
        rows = rows[np.lexsort((rows[:, 1], ~rows[:, 2], rows[:, 0]))]  # the least long has no negative
        return rows[np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0]) < self.k]
