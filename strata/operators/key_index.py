"""Unique keys across versions: an index of the keys so far, so that an increment looks up its own keys only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.buckets import BucketedTable
from strata.session import written

INDEX = "high bigint, low bigint, n bigint, first_increment bigint"


def _hashed(keys: Sequence[str]) -> list[Column]:
    """A key as two independent 64-bit hashes; NULLs are told from their places, so they compare as equal."""
    parts = [c for key in keys for c in (F.col(f"`{key}`").isNull(), F.col(f"`{key}`"))]
    return [F.xxhash64(F.lit(0), *parts).alias("high"), F.xxhash64(F.lit(1), *parts).alias("low")]


class KeyIndex:
    """How often each key occurred so far, in buckets; sixteen bytes a key, whatever its columns."""

    def __init__(self, spark: SparkSession, location: str, buckets: int = 64):
        self.table = BucketedTable(spark, location, ("high", "low"), INDEX, buckets)

    def flag_increment(self, df: DataFrame, keys: Sequence[str], number: int, flag: str = "_natural_key_unique") -> DataFrame:
        """The rows of increment ``number`` with the mark whether no other row so far, in it or before it, has their key.

        ``df`` is read once: it is written with its hashed keys, and all that follows reads these. Keys are counted
        per task before the exchange and looked up in the buckets they fall into; the repeated ones are
        written, so a few are broadcast and the rows stay where they are. Then the index takes the increment in. An
        increment that is flagged again after a crash is held against what came before it, not against itself.
        """
        rows = written(df.select("*", *[h.alias(f"_{i}") for i, h in enumerate(_hashed(keys))]), "indexed-rows")
        counted = written(rows.groupBy(F.col("_0").alias("high"), F.col("_1").alias("low")).agg(
            F.count(F.lit(1)).alias("n"), F.lit(number).cast("bigint").alias("first_increment")), "indexed-keys")
        version = self.table.version()
        before = self.table.read_touched(counted, self.table.folders(version))[1].where(F.col("first_increment") < number)
        known = counted.join(before.select("high", "low", F.lit(True).alias("_known")), ["high", "low"], "left")
        repeats = written(known.where("n > 1 OR _known").select(F.col("high").alias("_0"), F.col("low").alias("_1"), F.lit(True).alias("_dup")),
                          "repeated-keys")
        self.table.update(number, counted, merged)
        return rows.join(repeats, ["_0", "_1"], "left").withColumn(flag, F.col("_dup").isNull()).drop("_0", "_1", "_dup")

    def repeated(self) -> DataFrame:
        """Hashed keys that occurred more than once in all increments together."""
        return self.table.read().where("n > 1")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("high", "low").agg(
        F.sum("n").alias("n"), F.min("first_increment").alias("first_increment"))
