"""Yearly values kept up to date from new observations alone: a mergeable state instead of a rollup over everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.buckets import BucketedTable
from strata.operators.rollup import ANNUAL, QUARTERS

CELL_KEYS = ("series_id", "year", "period")
#: One cell per series, year and period: how many observations, their sum and maximum, and the increment they are of.
CELLS = ("series_id string, year int, period string, n bigint, total decimal(28,3), most decimal(18,3), as_of bigint")


def cells_of(obs: DataFrame, as_of: int) -> DataFrame:
    """The observations of one increment as cells, merged per task before the exchange."""
    return obs.groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(28,3)").alias("total"),
        F.max("value").cast("decimal(18,3)").alias("most"), F.lit(as_of).cast("bigint").alias("as_of"))


def added(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides' observations count: sums add up, the larger maximum stays. Associative and commutative."""
    return left.unionByName(right).groupBy(*CELL_KEYS).agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(28,3)").alias("total"), F.max("most").alias("most"), F.max("as_of").alias("as_of"))


def corrected(left: DataFrame, right: DataFrame) -> DataFrame:
    """Of every period the cell of the latest increment counts. Associative; also for periods long past."""
    latest = F.max_by(F.struct("n", "total", "most"), "as_of").alias("cell")
    merged = left.unionByName(right).groupBy(*CELL_KEYS).agg(latest, F.max("as_of").alias("as_of"))
    return merged.select(*CELL_KEYS, "cell.n", "cell.total", "cell.most", "as_of")


def rollup_of(cells: DataFrame) -> DataFrame:
    """What :func:`strata.operators.rollup.yearly_rollup` gives for the observations behind the cells.

    A cell of no observations (a correction that withdraws a period) counts as nothing.
    """
    period, there = F.col("period"), F.col("n") > 0
    quarterly, annual = period.isin(*QUARTERS), period == ANNUAL
    seen = F.lit(0)
    for position, code in enumerate(QUARTERS):
        seen = F.when(period == code, F.lit(1 << position)).otherwise(seen)

    def rows(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    return cells.where(there).groupBy("series_id", "year").agg(
        F.bit_count(F.bit_or(seen)).cast("bigint").alias("quarter_count"),
        F.sum(F.when(quarterly, F.col("total"))).cast("decimal(28,3)").alias("_quarterly_sum"),
        rows(annual).alias("_q05_count"),
        F.max(F.when(annual, F.col("most"))).alias("_q05_value"),
        rows(~period.isin(*QUARTERS, ANNUAL)).alias("_unexpected_period_count"),
    )


class YearlyState:
    """The cells of all increments so far, in buckets of the series."""

    def __init__(self, spark: SparkSession, location: str, buckets: int = 64):
        self.table = BucketedTable(spark, location, ("series_id",), CELLS, buckets)

    def add(self, number: int, obs: DataFrame, corrections: bool = False) -> bool:
        """Take in increment ``number`` (series_id, year, period, value), once; only buckets of its series are read.

        With ``corrections`` its observations replace those of the same series, year and period instead of
        adding to them. Returns False if that increment or a later one is in already.
        """
        cells = cells_of(obs.withColumns({"year": F.col("year").cast("int"), "value": F.col("value").cast("decimal(18,3)")}), number)
        return self.table.update(number, cells, corrected if corrections else added)

    def withdraw(self, number: int, periods: DataFrame) -> bool:
        """Take out the periods (series_id, year, period), whatever was observed there."""
        empty = periods.select(
            "series_id", F.col("year").cast("int").alias("year"), "period", F.lit(0).cast("bigint").alias("n"),
            F.lit(None).cast("decimal(28,3)").alias("total"), F.lit(None).cast("decimal(18,3)").alias("most"),
            F.lit(number).cast("bigint").alias("as_of"))
        return self.table.update(number, empty, corrected)

    def rollup(self, version: int | None = None) -> DataFrame:
        return rollup_of(self.table.read(version))
