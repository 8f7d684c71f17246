"""Yearly values from period observations, best years and range statistics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Period codes of the source.
QUARTERS = ("Q01", "Q02", "Q03", "Q04")
ANNUAL = "Q05"

KEEP, EXCLUDE = "keep", "exclude"


def yearly_rollup(obs: DataFrame, keys: Sequence[str] = ("series_id", "year")) -> DataFrame:
    """One row per key with what is known of its year, in one partial/final aggregate.

    The number of distinct quarters comes from a four-bit set instead of a distinct
    count, which would need a second exchange.
    """
    period, value = F.col("period"), F.col("value")
    quarterly = period.isin(*QUARTERS)
    annual = period == ANNUAL
    seen = F.lit(0)
    for position, code in enumerate(QUARTERS):
        seen = F.when(period == code, F.lit(1 << position)).otherwise(seen)
    # The names of the published helper columns.
    return obs.groupBy(*keys).agg(
        F.bit_count(F.bit_or(seen)).cast("bigint").alias("quarter_count"),
        F.sum(F.when(quarterly, value)).alias("_quarterly_sum"),
        F.count_if(annual).alias("_q05_count"),
        F.max(F.when(annual, value)).alias("_q05_value"),
        F.count_if(~period.isin(*QUARTERS, ANNUAL)).alias("_unexpected_period_count"),
    )


def yearly_rollup_check(obs: DataFrame, keys: Sequence[str] = ("series_id", "year")) -> DataFrame:
    """Plain version used to check the rollup: rows instead of distinct quarters are counted."""
    quarterly = F.col("period").isin(*QUARTERS)
    return obs.groupBy(*keys).agg(
        F.sum(F.when(quarterly, F.col("value"))).alias("quarterly_sum"),
        F.count_if(quarterly).alias("quarter_count"),
        F.max(F.when(F.col("period") == ANNUAL, F.col("value"))).alias("q05_value"),
    )


def _annual_only() -> Column:
    return (F.col("quarter_count") == 0) & (F.col("_q05_count") == 1)


def yearly_values(rollup: DataFrame, incomplete: str = KEEP) -> DataFrame:
    """Value of each year and how it was found.

    ``incomplete="keep"``: quarters win over the annual value and any of them will do;
    ``incomplete="exclude"``: only all four quarters count. A year without quarters
    takes its annual value if it has exactly one, else it has no value.
    """
    if incomplete not in (KEEP, EXCLUDE):
        raise ValueError(f"incomplete must be {KEEP!r} or {EXCLUDE!r}")
    complete = F.col("quarter_count") == 4
    some = F.col("quarter_count") > 0
    by_quarters, method = (some, "sum_available_quarters") if incomplete == KEEP else (complete, "sum_q01_q04")
    return rollup.withColumns(
        {
            "has_all_four_quarters": complete,
            "_recognized_periods_only": F.col("_unexpected_period_count") == 0,
            "_has_usable_yearly_value": by_quarters | _annual_only(),
            "_all_four_quarters_or_annual_only": complete | _annual_only(),
            "yearly_value": F.when(by_quarters, F.col("_quarterly_sum")).when(_annual_only(), F.col("_q05_value")),
            "value_method": F.when(by_quarters, F.lit(method)).when(_annual_only(), F.lit("annual_average_q05")),
        }
    )


def _ranked_first(yearly: DataFrame, value: str, rank: Column) -> DataFrame:
    return yearly.where(F.col(value).isNotNull()).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def best_period(yearly: DataFrame, key: str = "series_id", value: str = "yearly_value") -> DataFrame:
    """All rows holding the largest value of their key; keys with only NULLs drop out.

    The input is a rollup, so a key has at most one row per year, however many
    observations it had: no window group grows with the data. Ranking (not ``max`` over
    the window) lets Spark cut every task's rows to the leaders before the exchange.
    """
    by_key = Window.partitionBy(key).orderBy(F.col(value).desc())
    return _ranked_first(yearly, value, F.rank().over(by_key))


def best_period_by_dense_rank(yearly: DataFrame, key: str = "series_id", value: str = "yearly_value") -> DataFrame:
    """The same choice by dense rank, kept as an independent check of :func:`best_period`."""
    by_key = Window.partitionBy(key).orderBy(F.col(value).desc())
    return _ranked_first(yearly, value, F.dense_rank().over(by_key))


def in_years(first: int, last: int, year: str, day: str | None = None) -> Column:
    """Inclusive range of years; on a stored ``day`` column as bounds of it, which a scan can use to skip rows."""
    if day is None:
        return F.col(year).between(first, last)
    return (F.col(day) >= F.lit(date(first, 1, 1))) & (F.col(day) < F.lit(date(last + 1, 1, 1)))


def range_stats(df: DataFrame, first: int, last: int, value: str = "population", year: str = "year",
                carry: Sequence[str] = ("nation_id", "nation"), day: str | None = None) -> DataFrame:
    """Mean and sample deviation over an inclusive range of years; always one row."""
    constants = [F.max(name).alias(name) for name in carry]
    return (
        df.where(in_years(first, last, year, day))
        .agg(*constants, *_mean_and_deviation(value))
        .select(*carry, F.lit(first).alias("start_year"), F.lit(last).alias("end_year"),
                f"mean_{value}", f"stddev_{value}")
    )


def range_stats_grouped(df: DataFrame, first: int, last: int, value: str = "population", year: str = "year",
                        by: Sequence[str] = ("nation_id", "nation"), day: str | None = None) -> DataFrame:
    """The same per group, with the number of rows; no rows for an empty range."""
    return (
        df.where(in_years(first, last, year, day))
        .groupBy(*by)
        .agg(*_mean_and_deviation(value), F.count(F.lit(1)).alias("year_count"))
        .select(*by, F.lit(first).alias("start_year"), F.lit(last).alias("end_year"),
                f"mean_{value}", f"stddev_{value}", "year_count")
    )


def _mean_and_deviation(value: str) -> list[Column]:
    return [F.avg(value).alias(f"mean_{value}"), F.stddev_samp(value).alias(f"stddev_{value}")]
