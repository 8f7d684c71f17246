"""Means and deviations from stored moments: any union of ranges without its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, by: Sequence[str], value: str = "population") -> DataFrame:
    """``n, mean, m2`` per group: number of values, their mean and the sum of squared deviations from it."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2")).where("n > 0")


def _joined(left: Column, right: Column) -> Column:
    """Moments of two disjoint sets together, by the difference of their means; stable where sums of squares are not."""
    n = left["n"] + right["n"]
    apart = right["mean"] - left["mean"]
    return F.struct(
        n.alias("n"),
        (left["mean"] + apart * right["n"] / n).alias("mean"),
        (left["m2"] + right["m2"] + apart * apart * left["n"] * right["n"] / n).alias("m2"))


def merged(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Moments of the union of stored groups, per ``by`` or of all.

    A group's list holds one entry per stored moment (a year, a snapshot), not per row; entries are merged in the
    order of their size, so the result does not depend on how they arrive.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col("n").cast("double").alias("n"), "mean", "m2")))
    rest = F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0)))
    grouped = stored.groupBy(*by).agg(listed.alias("_all")).where(F.size("_all") > 0)
    folded = grouped.withColumn("_sum", F.reduce(rest, F.get("_all", F.lit(0)), _joined))
    return folded.select(*by, F.col("_sum.n").cast("bigint").alias("n"), F.col("_sum.mean").alias("mean"), F.col("_sum.m2").alias("m2"))


def mean_and_deviation(found: DataFrame, value: str = "population") -> DataFrame:
    """The moments' mean and sample deviation under the names of the range statistics; one value has no deviation."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return found.withColumns({f"mean_{value}": F.col("mean"), f"stddev_{value}": deviation}).drop("mean", "m2")
