"""Lookups: readable labels from code tables, measures joined by key.

No join here carries a broadcast hint. Spark broadcasts a lookup whose size, known from
its files or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``; a
larger one is joined by key, and AQE splits the partitions of codes that many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import duplicated_keys


@dataclass(frozen=True)
class Lookup:
    """A code table and the column of the coded frame that points into it."""

    table: DataFrame
    code: str
    text: str
    points_from: str


class AmbiguousLookup(ValueError):
    """A lookup key that should be unique is not."""


def label_lookup(coded: DataFrame, key: str, lookups: Sequence[Lookup], label_order: Sequence[str],
                 separator: str = " | ") -> DataFrame:
    """``key``, one text column per lookup, whether all were found, and the combined label."""
    labelled = coded.select(key, *[F.col(item.points_from).alias(f"_code_{i}") for i, item in enumerate(lookups)])
    for i, item in enumerate(lookups):
        texts = item.table.select(F.col(item.code).alias(f"_key_{i}"), F.col(item.text).alias(item.text))
        labelled = labelled.join(texts, F.col(f"_code_{i}") == F.col(f"_key_{i}"), "left")
    texts = [item.text for item in lookups]
    complete = reduce(Column.__and__, [F.col(name).isNotNull() for name in texts])
    return labelled.select(
        key,
        *texts,
        complete.alias("_label_lookup_complete"),
        F.concat_ws(separator, *label_order).alias("human_readable_label"),
    )


def one_per_key(lookup: DataFrame, on: str) -> DataFrame:
    """The lookup, or an error if it has several rows for one key; runs a job over its keys."""
    if not duplicated_keys(lookup, [on]).isEmpty():
        raise AmbiguousLookup(f"lookup has several rows for one {on}")
    return lookup


def enrich(facts: DataFrame, lookup: DataFrame, on: str, expect_unique: bool = False) -> DataFrame:
    """Every fact with the lookup's columns, NULL where the lookup has no such key.

    A lookup with several rows per key multiplies facts; ``expect_unique`` makes that an error.
    """
    found = (one_per_key(lookup, on) if expect_unique else lookup).withColumnRenamed(on, "_lookup_key")
    return facts.join(found, F.col(on) == F.col("_lookup_key"), "left").drop("_lookup_key")


def unmatched(lookup: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Lookup rows that no fact refers to; the facts are reduced to their distinct keys first."""
    return lookup.join(facts.select(on).distinct(), on, "left_anti")
