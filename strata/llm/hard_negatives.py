"""Hard negatives by angular triangle filtering.

An anchor's positives are its nearest rows of the same label by integer inner product; the hard negatives of a positive are
the nearest rows of other labels whose score lies in a window below the positive's. Every row is stored with its norm and
its angles to reference directions. Two rows' angle lies between the greatest difference and the least sum of their angles
to one reference; the cosines of these, times both norms, bound their score from both sides, with slack for
rounding. Rows are stored in order of nearest reference and angle, so that whole blocks are passed over by their
intervals first; single pairs are by theirs. Only pairs whose bounds overlap a window are scored, in integers.

Rows with a null label or vec_id, a null vector, or null or non-finite components take no part; shorter vectors count as ending
in zeros, zero vectors score 0. Rows of the anchor's vec_id are not other rows; repeated rows are rows of their
own. A negative positive score has no window. An empty table gives an empty result. Other columns are not read,
whatever their names. References come from a bounded sample (``SAMPLE`` rows); they change the speed only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.vectors import LEAST, MOST, QUERY_BLOCK, ROW_BLOCK, Best, integer_rows, pair_products, products, waves
from strata.session import written

REFERENCES, SAMPLE = 16, 2000
#: Share of the norms' product that bounds are widened by: angles are kept in single precision.
SLACK = 5e-6
#: A block is scored as a matrix if at least this share of its pairs is left.
DENSE = 0.1


def references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors that lie far apart among a sample of the rows, one after another the farthest from those before."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow().combine_chunks().to_batches()
    at = integer_rows(some[0], "v", 1)[1] if some else np.zeros((0, 0))
    norms = np.sqrt((at * at).sum(axis=1))
    at = at[(norms > 0) & np.isfinite(norms)] / norms[(norms > 0) & np.isfinite(norms), None]
    if not len(at):
        return np.zeros((0, at.shape[1]))
    chosen = [0]
    nearest = at @ at[0]
    while len(chosen) < min(count, len(at)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, at @ at[chosen[-1]])
    return at[chosen]


def angles_to(vectors: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of every vector to every direction; of a zero vector all are zero, its norm makes its bounds 0."""
    width = min(vectors.shape[1], directions.shape[1])
    if not len(directions) or not width:
        return np.full((len(vectors), len(directions)), np.float32(np.pi / 2))
    scaled = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    angles = np.arccos(np.clip(scaled[:, :width] @ directions[:, :width].T, -1.0, 1.0)).astype(np.float32)
    angles[norms == 0] = 0
    return angles


STORED = "vec_id long, label int, v array<double>, norm double, angles array<float>, home int, near float"


def stored(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` (vec_id, label, v) as integer vectors with norms and angles, written in order of nearest reference and angle."""
    usable = written(rows.mapInArrow(scaled_rows(scale), "vec_id long, label int, v array<double>"), "integer-vectors")
    sent = usable.sparkSession.sparkContext.broadcast(references(usable))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = integer_rows(batch, "v", 1)[1]
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            angles = angles_to(vectors, norms, sent.value)
            home = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(angles), np.int64)
            near = angles[np.arange(len(angles)), home] if angles.shape[1] else np.zeros(len(angles), np.float32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), listed(angles), pa.array(home.astype(np.int32)), pa.array(near)],
                "vec_id label v norm angles home near".split())

    placed = usable.mapInArrow(measure, STORED)
    return written(placed.repartitionByRange("home", "near", "vec_id").sortWithinPartitions("home", "near", "vec_id"), "angle-index")


def scaled_rows(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vectors = integer_rows(batch, "v", scale)
            own = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), listed(vectors)], ["vec_id", "label", "v"])
    return run


def listed(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))


class Anchors:
    """A wave of anchors and, for each, windows of scores in which its best rows are looked for."""

    def __init__(self, ids, labels, vectors, angles, norms, low: np.ndarray, high: np.ndarray, same: bool):
        self.ids, self.labels, self.vectors, self.angles, self.norms = ids, labels, vectors, angles, norms
        self.low, self.high, self.same = low, high, same


def bounded(gap: np.ndarray, total: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of scores from least and greatest angles, with slack for rounding."""
    slack = 2 + SLACK * product
    return np.cos(np.minimum(total, np.float32(np.pi))) * product - slack, np.cos(gap) * product + slack


def block_bounds(anchors: Anchors, block: slice, angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each anchor's scores with any row of a block, from the block's intervals."""
    own = anchors.angles[block]
    if not own.shape[1]:
        return np.full(len(own), -np.inf), np.full(len(own), np.inf)
    least, most = angles.min(axis=0), angles.max(axis=0)
    gap = np.maximum(np.maximum(least - own, own - most), 0).max(axis=1)
    total = (own + most).min(axis=1)
    lowest = [bounded(gap, total, anchors.norms[block] * norm) for norm in (norms.min(), norms.max())]
    return np.minimum(lowest[0][0], lowest[1][0]), np.maximum(lowest[0][1], lowest[1][1])


def pair_bounds(angles: np.ndarray, norms: np.ndarray, row_angles: np.ndarray, row_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = np.zeros((len(angles), len(row_angles)), np.float32)
    total = np.full(gap.shape, np.float32(np.pi))
    for own, other in zip(angles.T, row_angles.T):
        np.maximum(gap, np.abs(own[:, None] - other[None, :]), out=gap)
        np.minimum(total, own[:, None] + other[None, :], out=total)
    return bounded(gap, total, norms[:, None] * row_norms[None, :])


def windows(sent: Broadcast, k: int):
    """The best ``k`` rows of a task for every window, as ``number`` (of the window), ``vec_id``, ``score``.

    A window's lower end rises to the kth score found for it so far.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = sent.value
        best, many = Best(k), anchors.low.shape[1]
        low = anchors.low.copy()
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                for first in range(0, batch.num_rows, ROW_BLOCK):
                    search(batch.slice(first, ROW_BLOCK), anchors, low, best)
                    rows = best.rows()
                    best.held, best.size = [rows], 0
                    last = np.flatnonzero(np.append(rows[1:, 0] != rows[:-1, 0], True)) if len(rows) else np.zeros(0, int)
                    full = last[np.searchsorted(rows[:, 0], rows[last, 0], side="right") - np.searchsorted(rows[:, 0], rows[last, 0]) >= k]
                    ends = low.reshape(-1)
                    ends[rows[full, 0]] = np.maximum(ends[rows[full, 0]], rows[full, 2])
        number, vec, score = best.rows().T
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(vec), pa.array(score)], ["number", "vec_id", "score"])

    def search(part: pa.RecordBatch, anchors: Anchors, low: np.ndarray, best: Best) -> None:
        vectors = integer_rows(part, "v", 1)[1]
        ids, labels, norms = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "norm"))
        angles = part.column("angles").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
        for start in range(0, len(anchors.ids), QUERY_BLOCK):
            block = slice(start, start + QUERY_BLOCK)
            least, most = block_bounds(anchors, block, angles, norms)
            wanted, allowed = low[block].min(axis=1), anchors.high[block].max(axis=1)
            chosen = start + np.flatnonzero(~(most < wanted) & ~(least > allowed) & (wanted <= allowed))
            if not len(chosen):
                continue
            least, most = pair_bounds(anchors.angles[chosen], anchors.norms[chosen], angles, norms)
            left = (anchors.labels[chosen][:, None] == labels[None, :]) == anchors.same
            left &= (anchors.ids[chosen][:, None] != ids[None, :])
            left &= ~(most < low[chosen].min(axis=1)[:, None]) & ~(least > anchors.high[chosen].max(axis=1)[:, None])
            at, row = np.nonzero(left)
            if len(at) >= DENSE * left.size:
                scores = products(anchors.vectors[chosen], vectors)[at, row]
            else:
                scores = np.concatenate([pair_products(anchors.vectors[chosen[at[i:i + 100_000]]], vectors[row[i:i + 100_000]])
                                         for i in range(0, max(len(at), 1), 100_000)])
            for window in range(low.shape[1]):
                fits = (scores >= low[chosen[at], window]) & (scores <= anchors.high[chosen[at], window])
                best.add(chosen[at[fits]] * low.shape[1] + window, ids[row[fits]], scores[fits])

    return run


def best_in_windows(index: DataFrame, anchors: Anchors, k: int, label: str) -> DataFrame:
    """``number, rank, vec_id, score``: the best ``k`` rows of each window."""
    sent = index.sparkSession.sparkContext.broadcast(anchors)
    found = written(index.mapInArrow(windows(sent, k), "number long, vec_id long, score long"), label)
    sent.unpersist()
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, scale: int = 256,
         percent: int = 80, vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``is_anchor``.

    A negative fits a positive if its score is at most the positive's and at least ``percent`` hundredths of it.
    Anchors go round in waves of bounded size; with each, the index is read twice.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), F.col(vector).cast("array<double>").alias("v"),
        is_anchor.alias("_anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    index = stored(rows.select("vec_id", "label", "v"), scale)
    spark = vectors.sparkSession
    mined = []
    anchor_ids = rows.where("_anchor").select("vec_id").distinct()
    for wave in waves(index.join(anchor_ids, "vec_id", "left_semi").select("vec_id", "label", "v", "norm", "angles")):
        ids, labels, norms = (wave.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "norm"))
        own = integer_rows(wave, "v", 1)[1]
        angles = wave.column("angles").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        anywhere = np.full((len(ids), 1), LEAST), np.full((len(ids), 1), MOST)
        same = best_in_windows(index, Anchors(ids, labels, own, angles, norms, *anywhere, True), positives, "positives")
        near = same.orderBy("number", "rank").toArrow()
        anchor, place, positive, score = (near.column(c).to_numpy() for c in ("number", "rank", "vec_id", "score"))
        low, high = np.full((len(ids), positives), MOST), np.full((len(ids), positives), LEAST)
        usable = score >= 0
        low[anchor[usable], place[usable] - 1] = least_score(score[usable], percent)
        high[anchor[usable], place[usable] - 1] = score[usable]
        hard = best_in_windows(index, Anchors(ids, labels, own, angles, norms, low, high, False), negatives, "negatives")
        names = spark.createDataFrame(pa.table({
            "number": pa.array(anchor * positives + place - 1, pa.int64()), "anchor_id": pa.array(ids[anchor], pa.int64()),
            "positive_id": pa.array(positive, pa.int64()), "positive_score": pa.array(score, pa.int64())}))
        mined.append(written(names.join(hard, "number").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")),
            "hard-negatives"))
    if not mined:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found = mined[0]
    for more in mined[1:]:
        found = found.unionByName(more)
    return found


def least_score(score: np.ndarray, percent: int) -> np.ndarray:
    """The least integer that is ``percent`` hundredths of ``score`` or more, without leaving 64 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * percent - (-rest * percent // 100)
