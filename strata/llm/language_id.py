"""Language identification by rank-order profiles of letter n-grams.

A text that is null, empty or without a letter is ``und`` with score 0. Rows with a null language
or text teach nothing; without any teaching rows everything is ``und``. Equal counts rank by code
point, equal distances by language name. Very long texts are counted whole. Columns of the documents are
kept unless a result has their name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import let_go, slices, tidy

#: Length of a profile.
TOP = 300
_PAD = 1

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
COUNTS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])


@functools.cache
def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_codes(text: str | None) -> np.ndarray:
    """n-grams of one to three letters within words, a word having a mark on either side, as numbers."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    letters = letter_table()[points]
    if not letters.any():
        return np.empty(0, np.int64)
    marked = np.concatenate([[_PAD], np.where(letters, points, _PAD), [_PAD]])
    inside = marked != _PAD
    marked = marked[inside | np.concatenate([[True], inside[:-1]])]
    if marked[-1] != _PAD:
        marked = np.append(marked, _PAD)
    two = marked[:-1] << 21 | marked[1:]
    three = two[:-1] << 21 | marked[2:]
    return np.concatenate([marked[marked != _PAD], two, three[marked[1:-1] != _PAD]])


def ranked(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams, in order of rank."""
    grams, counts = np.unique(codes, return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Language profiles as one table of ranks: a row per n-gram, a column per language."""

    def __init__(self, by_language: dict[str, list[int]], top: int = TOP):
        self.top = top
        self.languages = sorted(by_language)
        self.grams = np.unique(np.array([g for grams in by_language.values() for g in grams], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)
        for column, language in enumerate(self.languages):
            grams = np.array(by_language[language], np.int64)
            self.ranks[np.searchsorted(self.grams, grams), column] = np.arange(len(grams))

    def best(self, text: str | None) -> tuple[str, float]:
        """The language of least out-of-place distance, and one minus that distance's share of the largest."""
        grams = ranked(gram_codes(text), self.top)
        if not len(grams) or not self.languages:
            return "und", 0.0
        at = np.searchsorted(self.grams, grams)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != grams)] = len(self.grams)
        ranks = self.ranks[at]
        distance = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(grams))[:, None])).sum(axis=0)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.top * len(grams)))


def learn_profiles(docs: DataFrame, top: int = TOP) -> Profiles:
    """Profiles from ``docs(text, lang)``, counted over all rows.

    A task adds up its own counts before the exchange, so a language that holds most rows is no
    larger than another; only ``top`` rows a language reach the driver.
    """
    @tidy
    def count(batches):
        let_go("languages")
        held: dict[str, list] = {}
        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    held.setdefault(lang, []).append(np.unique(gram_codes(text), return_counts=True))
                for lang, pairs in held.items():
                    held[lang] = [added(pairs)]
        for lang, pairs in held.items():
            grams, counts = added(pairs)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], COUNTS.names)

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sums = rows.mapInArrow(count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    by_language: dict[str, dict[int, int]] = {}
    for row in best.select("lang", "gram", "rank").collect():
        by_language.setdefault(row["lang"], {})[row["rank"]] = row["gram"]
    return Profiles({lang: [grams[r] for r in sorted(grams)] for lang, grams in by_language.items()}, top)


def added(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(pairs) == 1:
        return pairs[0]
    grams, at = np.unique(np.concatenate([g for g, _ in pairs]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([c for _, c in pairs]), len(grams)).astype(np.int64)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, in one pass without an exchange."""
    kept = [name for name in docs.columns if name.lower() not in RESULT.names]
    rows = docs.select(*kept)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @tidy
    def run(batches):
        let_go("languages")
        best = shared.value.best
        for batch in batches:
            for part in slices(batch):
                found = [best(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())],
                    [*part.schema.names, *RESULT.names])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *RESULT.fields]))


def keep_identified(docs: DataFrame, profiles: Profiles, least_score: float = 0.0, above: float = -1.0) -> DataFrame:
    """The documents, with their own columns, that have a language (and at least that score, and more than ``above``)."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    found = identify(inner, profiles).where((F.col("lang_pred") != "und") & (F.col("score") >= least_score) & (F.col("score") > above))
    return found.select("row.*")
