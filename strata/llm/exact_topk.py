"""Exact top-k search by inner product: a distributed histogram selection.

Every query is scored against every row. Tasks count scores in the bins of a range that holds the query's kth score,
the counts are added up, and the bin with the kth score becomes the next range, until few scores lie in it or above.
A last pass keeps what reaches the range; ranks follow, ties to the smaller vec_id.

Vectors that are null or hold null or non-finite components, and rows without vec_id, take no part; shorter vectors count
as ending in zeros. A row is not compared with rows of its own vec_id; repeated rows are rows of their own, as
candidates and as queries. Scores beyond 64 bits are the nearest long. Zero vectors score 0. An empty table gives an
empty result, fewer than k candidates give all. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.vectors import LEAST, QUERY_BLOCK, ROW_BLOCK, Best, integer_rows, products, waves
from strata.session import written

#: Bins of a range, and how many times k scores may be left when refining ends.
BINS, ENOUGH = 512, 8
#: Scores beyond this count as this while the kth is looked for.
FAR = 2 ** 61


class Ranges:
    """Where the kth score of each query of a wave lies: in ``span`` from ``low`` on, cut into bins of ``width``.

    ``above`` scores lie beyond the span. The last bins may reach past its end: what lies there is counted already.
    """

    def __init__(self, reach: np.ndarray, k: int):
        self.k = k
        self.low = -reach
        self.span = 2 * reach + 1
        self.width = -(-self.span // BINS)
        self.above = np.zeros(len(reach), np.int64)
        self.open = np.ones(len(reach), bool)

    def narrow(self, query: np.ndarray, bins: np.ndarray, counts: np.ndarray) -> None:
        """Take in the counts, which hold at least every bin from the one with the kth score on."""
        order = np.lexsort((-bins, query))
        query, bins, counts = query[order], bins[order], counts[order]
        for i in np.flatnonzero(self.open):
            start, stop = np.searchsorted(query, [i, i + 1])
            reached = self.above[i] + np.cumsum(counts[start:stop])
            at = int(np.searchsorted(reached, self.k))
            if at == len(reached):  # fewer than k scores
                self.low[i], self.open[i] = LEAST, False
                continue
            self.low[i] += bins[start + at] * self.width[i]
            self.above[i] = reached[at] - counts[start + at]
            if self.width[i] == 1 or reached[at] <= ENOUGH * self.k:
                self.open[i] = False
            self.span[i] = self.width[i]
            self.width[i] = -(-self.span[i] // BINS)

    def least(self) -> np.ndarray:
        """The least score of each query that may be among its best; the lowest score looked for stands for all below it."""
        return np.where(self.low <= -FAR, LEAST, self.low)


def scored(batches: Iterator[pa.RecordBatch], scale: int, queries: np.ndarray, ids: np.ndarray,
           take: Callable[[slice, np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Call ``take`` with the scores of every block of queries and rows, and which of them count."""
    for batch in batches:
        at, rows = integer_rows(batch, "v", scale)
        vec_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)[at]
        for first in range(0, len(rows), ROW_BLOCK):
            part, own = rows[first:first + ROW_BLOCK], vec_ids[first:first + ROW_BLOCK]
            for start in range(0, len(queries), QUERY_BLOCK):
                block = slice(start, start + QUERY_BLOCK)
                take(block, products(queries[block], part), own[None, :] != ids[block][:, None], own)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of every row that ``is_query`` the ``k`` other rows of highest score.

    Queries go round in waves of bounded size; with each, the table is read once per refinement. A task hands on
    bins and rows from its own kth score up only, which is all that can count, so at most ``k`` of each per query.
    """
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("_query"))
    candidates = rows.where(F.col("v").isNotNull()).select("vec_id", "v")
    spark = vectors.sparkSession
    reach = float(written(candidates.mapInArrow(longest(scale), "reach double").agg(F.max("reach").alias("reach")), "top-k").first()["reach"] or 0.0)
    found = []
    for wave in waves(rows.where("_query AND v IS NOT NULL").select("vec_id", "v")):
        at, queries = integer_rows(wave, "v", scale)
        ids = wave.column("vec_id").to_numpy(zero_copy_only=False)[at]
        with np.errstate(over="ignore", invalid="ignore"):
            most = np.nan_to_num(np.sqrt((queries * queries).sum(axis=1)) * reach, nan=0.0, posinf=FAR)  # zero vectors score 0
        ranges = Ranges(np.minimum(np.ceil(most * (1 + 1e-9)) + 1, FAR).astype(np.int64), k)
        sent = spark.sparkContext.broadcast((ids, queries))
        while ranges.open.any():
            counts = candidates.mapInArrow(counted(sent, scale, ranges), "query int, bin long, n long")
            total = counts.groupBy("query", "bin").agg(F.sum("n").alias("n")).toArrow()
            ranges.narrow(*(total.column(c).to_numpy() for c in ("query", "bin", "n")))
        found.append(written(candidates.mapInArrow(reaching(sent, scale, ranges.least(), k), "query int, query_id long, vec_id long, score long")
                             .withColumn("wave", F.lit(len(found))), "top-k"))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kept = found[0]
    for more in found[1:]:
        kept = kept.unionByName(more)
    best = Window.partitionBy("wave", "query").orderBy(F.desc("score"), F.asc("vec_id"))
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def longest(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 0.0
        for batch in batches:
            rows = integer_rows(batch, "v", scale)[1]
            most = max(most, float(np.sqrt((rows * rows).sum(axis=1)).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["reach"])
    return run


def counted(sent, scale: int, ranges: Ranges):
    """Scores per bin, of a task's bins from the highest to the one that holds the task's kth score."""
    low, span, width, above, k, turn = ranges.low, ranges.span, ranges.width, ranges.above, ranges.k, np.flatnonzero(ranges.open)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        bins = np.zeros((len(turn), BINS), np.int64)

        def take(block: slice, scores: np.ndarray, counts: np.ndarray, own: np.ndarray) -> None:
            numbers = turn[block]
            lowest, wide = low[numbers][:, None], width[numbers][:, None]
            scores = np.clip(scores, -FAR, FAR)
            counts &= (scores >= lowest) & (scores - lowest < span[numbers][:, None])
            query, at = np.nonzero(counts)
            flat = (query + block.start) * BINS + (scores[query, at] - lowest[query, 0]) // wide[query, 0]
            first = block.start * BINS
            bins.reshape(-1)[first:first + len(numbers) * BINS] += np.bincount(flat - first, minlength=len(numbers) * BINS)

        scored(batches, scale, queries[turn], ids[turn], take)
        down = np.cumsum(bins[:, ::-1], axis=1)[:, ::-1]
        query, at = np.nonzero((bins > 0) & (down - bins < k - above[turn][:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(turn[query].astype(np.int32)), pa.array(at.astype(np.int64)), pa.array(bins[query, at])], ["query", "bin", "n"])
    return run


def reaching(sent, scale: int, low: np.ndarray, k: int):
    """Rows whose score reaches the query's range; of a task's the best ``k``, ties to the smaller vec_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        best = Best(k)

        def take(block: slice, scores: np.ndarray, counts: np.ndarray, own: np.ndarray) -> None:
            query, at = np.nonzero(counts & (scores >= low[block][:, None]))
            best.add(query + block.start, own[at], scores[query, at])

        scored(batches, scale, queries, ids, take)
        query, vec, score = best.rows().T
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(ids[query]), pa.array(vec), pa.array(score)],
            ["query", "query_id", "vec_id", "score"])
    return run
