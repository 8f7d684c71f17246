"""Differences of two tables by a tree of checksums: rows move only where the sums of a bucket differ."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import written

#: Leaves of the tree and children of a node.
LEAVES, FAN_OUT = 4096, 16
_WHOLE = "decimal(38,0)"


def _rows_hash(names: Sequence[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.col(f"`{name}`") for name in names])


def _bucket(names: Sequence[str], leaves: int) -> Column:
    return F.pmod(_rows_hash(names, 0), F.lit(leaves)).cast("int")


def leaf_sums(df: DataFrame, keys: Sequence[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """``leaf, n, first_sum, second_sum``: rows of each bucket and two sums of independent 64-bit row hashes.

    Sums do not depend on the order of rows and count repeated ones. One pass over the rows; a task hands on at
    most ``leaves`` rows of three numbers. With ``keys`` a row's bucket is that of its key, so both versions of a
    changed row fall into one bucket.
    """
    names = df.columns
    return df.select(
        _bucket(keys or names, leaves).alias("leaf"), _rows_hash(names, 1).cast(_WHOLE).alias("_first"),
        _rows_hash(names, 2).cast(_WHOLE).alias("_second"),
    ).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_first").alias("first_sum"), F.sum("_second").alias("second_sum"))


@dataclass(frozen=True)
class Level:
    """Nodes of one level that differ, of how many."""

    width: int
    differing: list[int]


def differing_nodes(left_sums: DataFrame, right_sums: DataFrame, leaves: int = LEAVES, fan_out: int = FAN_OUT) -> list[Level]:
    """The differing nodes of every level, from the root down; only children of a differing node are compared.

    Works on the stored sums, at most ``leaves`` rows a side, so either side's sums may come from another place
    or time: a table can be held against what it was without reading what it was.
    """
    def sums(df: DataFrame, step: int) -> DataFrame:
        return df.groupBy(F.floor(F.col("leaf") / step).cast("int").alias("node")).agg(
            F.sum("n").alias("n"), F.sum("first_sum").alias("first_sum"), F.sum("second_sum").alias("second_sum"))

    levels, step = [], 1
    while step < leaves:
        step *= fan_out
    above: list[int] | None = None
    while True:
        sides = [sums(side, step) for side in (left_sums, right_sums)]
        if above is not None:
            sides = [side.where(F.floor(F.col("node") / fan_out).cast("int").isin(above)) for side in sides]
        both = sides[0].withColumn("_side", F.lit(1)).unionByName(sides[1].withColumn("_side", F.lit(-1)))
        signed = [F.sum(F.col(c) * F.col("_side")).alias(c) for c in ("n", "first_sum", "second_sum")]
        found = both.groupBy("node").agg(*signed).where("n <> 0 OR first_sum <> 0 OR second_sum <> 0")
        above = sorted(row.node for row in found.select("node").toLocalIterator())
        levels.append(Level(-(-leaves // step), above))
        if not above or step == 1:
            return levels
        step //= fan_out


def signed_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often, with ``surplus``: how many more the left has (negative: the right).

    Both directions of ``EXCEPT ALL`` in one aggregate; repeated rows are merged before the exchange.
    """
    names = left.columns
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return sides.groupBy(*[F.col(f"`{n}`") for n in names]).agg(F.sum("_side").alias("surplus")).where("surplus <> 0")


def tree_diff(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """:func:`signed_diff`, but only rows of differing buckets are moved.

    Two equal tables cost one narrow pass each and no exchange of rows. That buckets with different rows have
    equal sums of both hashes has a chance of about 2 to the -128 a bucket. Both sides are read again where
    buckets differ: hand in data that does not move in between.
    """
    sums = [written(leaf_sums(side, keys, leaves), "leaf-sums") for side in (left, right.select(*[f"`{n}`" for n in left.columns]))]
    bad = differing_nodes(*sums, leaves)[-1].differing
    if not bad:
        return signed_diff(left.where(F.lit(False)), right.where(F.lit(False)))
    spread = F.array_contains(F.lit(bad), _bucket(keys or left.columns, leaves)) if len(bad) < leaves else F.lit(True)
    return signed_diff(left.where(spread), right.where(spread))
