"""Document quality by a regularised quadratic discriminant on text statistics.

Null and empty texts have the statistics of an empty text. Labels that are null, or whose document is
missing, teach nothing; if a class has no rows, the score of every text is the share of label 1
among the teaching rows (one half without any). Repeated labels count each time. Only doc_id and text of
the documents are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents_only, lists, slices
from strata.session import written

STATISTICS = (
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "symbols", "top_symbol", "distinct_words",
    "same_as_previous", "repeated_pairs", "repeated_lines", "log_line", "symbol_ends", "stops", "capitals", "long_words",
)
SHRINK, RIDGE = 0.1, 1e-3
_SYMBOL = re.compile(r"[^\w\s]")
_SYMBOL_END = re.compile(r"[^\w\s.,;:!?'\")]+(?:\s|$)|[!?]{2,}")

FEATURES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("stats", T.ArrayType(T.DoubleType()))])


def share(part: float, whole: float) -> float:
    """A share on the arcsine scale, where its spread does not depend on its size."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``STATISTICS``."""
    text = text or ""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    chars, n = len(text), len(words)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    wide = int(counts[0xC0:].sum())
    symbols = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    odd = counts.copy()
    odd[:33] = odd[48:58] = odd[65:91] = odd[97:123] = odd[127:] = 0
    odd[[ord(c) for c in ".,"]] = 0
    pairs = Counter(zip(words, words[1:]))
    return [
        np.log1p(chars), np.log1p(n), np.log1p(sum(map(len, words)) / n if n else 0),
        share(upper + lower + wide, chars), share(upper, upper + lower + wide), share(digits, chars), share(symbols, chars),
        share(int(odd.max()), chars), np.log1p(len(set(words))) - np.log1p(n),
        share(sum(a == b for a, b in zip(words, words[1:])), n), share(n - 1 - len(pairs) if n else 0, n),
        share(len(lines) - len(set(lines)), len(lines)), np.log1p(chars / len(lines) if lines else 0),
        share(len(_SYMBOL_END.findall(text)), n), share(text.count("."), n),
        share(sum(map(str.istitle, words)), n), share(sum(len(w) > 24 for w in words), n),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """``(doc_id, stats)`` of every document, in one pass."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                stats = np.array([statistics(text) for text in part.column("text").to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    lists(np.arange(0, stats.size + 1, len(STATISTICS)), pa.array(stats.ravel()))], FEATURES.names)
    return documents_only(docs).mapInArrow(run, FEATURES)


class Discriminant:
    """Two normal densities with shrunk covariances, kept as Cholesky factors."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float = SHRINK, ridge: float = RIDGE):
        self.counts = counts
        self.ready = bool((counts > 1).all())
        if not self.ready:
            return
        means = sums / counts[:, None]
        scatter = squares - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(axis=0) / counts.sum()
        self.centre, self.scale = sums.sum(axis=0) / counts.sum(), np.sqrt(np.diag(pooled) + 1e-12) + 1e-6
        self.means = (means - self.centre) / self.scale
        within = pooled / np.outer(self.scale, self.scale)
        self.factors, self.offsets = [], []
        for label in (0, 1):
            own = scatter[label] / counts[label] / np.outer(self.scale, self.scale)
            target = 0.5 * within + 0.5 * np.eye(len(own)) * np.trace(own) / len(own)
            covariance = (1 - shrink) * own + shrink * target + ridge * np.eye(len(own))
            factor = np.linalg.cholesky(covariance)
            self.factors.append(np.linalg.inv(factor))
            self.offsets.append(np.log(counts[label] / counts.sum()) - np.log(np.diag(factor)).sum())

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if not self.ready:
            total = self.counts.sum()
            return np.full(len(stats), self.counts[1] / total if total else 0.5)
        at = (stats - self.centre) / self.scale
        density = [
            offset - 0.5 * (((at - mean) @ factor.T) ** 2).sum(axis=1)
            for offset, mean, factor in zip(self.offsets, self.means, self.factors)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


SUMS = T.StructType([
    T.StructField("label", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType())])


def fit(stats: DataFrame, labels: DataFrame, width: int = len(STATISTICS)) -> Discriminant:
    """Fit on all rows of ``labels(doc_id, label)`` that have statistics.

    A task reduces its rows to counts, sums and products of each class; Spark adds those up, and only
    the totals reach the driver.
    """
    def run(batches):
        total = np.zeros((2, width + 1, width + 1))
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            at = np.asarray(batch.column("stats").flatten()).reshape(-1, width)
            at = np.hstack([np.ones((len(at), 1)), at])
            for c in (0, 1):
                total[c] += at[label == c].T @ at[label == c]
        size = (width + 1) ** 2
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([0, 1], size).astype(np.int32)), pa.array(np.tile(np.arange(size), 2).astype(np.int32)),
            pa.array(total.ravel())], SUMS.names)

    known = labels.where("label IN (0, 1)").select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
    sums = stats.join(known, "doc_id").select("label", "stats").mapInArrow(run, SUMS)
    total = np.zeros((2, (width + 1) ** 2))
    for row in sums.groupBy("label", "k").agg(F.sum("v").alias("v")).collect():
        total[row["label"], row["k"]] = row["v"]
    total = total.reshape(2, width + 1, width + 1)
    return Discriminant(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:])


def apply(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` for rows of ``measure``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = np.asarray(batch.column("stats").flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(at))], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score)`` for every document, learning from ``labels(doc_id, label)``.

    Texts are read once: their statistics, some hundred bytes a document, are written and used for both.
    """
    stats = written(measure(docs), "quality-statistics")
    return apply(stats, fit(stats, labels))
