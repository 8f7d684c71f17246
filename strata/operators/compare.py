"""Checks of one result against another: two-way difference and layer traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.measures import gap, gap_or_zero
from strata.operators.rollup import yearly_rollup_check


def two_way_diff(left: DataFrame, right: DataFrame, only_left: str, only_right: str,
                 kind: str = "mismatch_type") -> DataFrame:
    """Distinct rows found on one side only, labelled with the side.

    Both directions of ``EXCEPT`` in one aggregate: each input is read once, repeated
    rows are merged before the exchange, and equal rows (NULLs included) meet by grouping.
    """
    names = left.columns
    sides = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    grouped = sides.groupBy(*[F.col(f"`{name}`") for name in names]).agg(
        F.bool_or("_left").alias("_in_left"), F.bool_or(~F.col("_left")).alias("_in_right")
    )
    label = F.when(F.col("_in_left"), only_left).otherwise(only_right)
    return grouped.where("_in_left <> _in_right").select(label.alias(kind), *[F.col(f"`{n}`") for n in names])


def diff_counts(left: DataFrame, right: DataFrame, only_left: str, only_right: str) -> DataFrame:
    """The number of distinct rows on one side only; always two rows, zeros included."""
    diff = two_way_diff(left, right, only_left, only_right)
    counted = diff.agg(*[F.count_if(F.col("mismatch_type") == side).alias(side) for side in (only_left, only_right)])
    rows = [
        F.struct(F.lit(side).alias("comparison"), F.col(f"`{side}`").alias("differences"))
        for side in (only_left, only_right)
    ]
    return counted.select(F.inline(F.array(*rows)))


def case_rollup(cases: DataFrame, obs: DataFrame, on: Sequence[str] = ("series_id", "year")) -> DataFrame:
    """The plain yearly rollup of the chosen cases only, with the case names."""
    chosen = obs.join(cases, list(on), "inner")
    return yearly_rollup_check(chosen, ["test_case", *on])


def _complete_value(rolled: DataFrame, layer: str) -> DataFrame:
    value = F.when(F.col("quarter_count") == 4, F.col("quarterly_sum")).when(
        F.col("quarter_count") == 0, F.col("q05_value")
    )
    return rolled.select(
        "test_case", "series_id", "year",
        F.col("quarter_count").alias(f"{layer}_quarter_count"),
        value.alias(f"{layer}_yearly_value"),
    )


def layer_trace(cases: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Yearly values of the cases in raw, typed and answer layer, with the gaps between them.

    ``bronze`` holds strings and is converted here, on its own path, so that an error in
    the typing shows up as a gap. ``gold`` has series_id, best_year and yearly_value.
    """
    raw = bronze.select(
        F.trim("series_id").alias("series_id"),
        F.trim("year").try_cast("int").alias("year"),
        F.trim("period").alias("period"),
        F.trim("value").try_cast("double").alias("value"),
    )
    answers = gold.select("series_id", F.col("best_year").alias("year"), F.col("yearly_value").alias("gold_yearly_value"))
    below = _complete_value(case_rollup(cases, raw), "bronze")
    middle = _complete_value(case_rollup(cases, silver), "silver")
    traced = below.join(middle, ["test_case", "series_id", "year"], "inner").join(
        answers, ["series_id", "year"], "left"
    )
    value = {layer: F.col(f"{layer}_yearly_value") for layer in ("bronze", "silver", "gold")}
    return traced.select(
        "test_case", "series_id", "year",
        "bronze_quarter_count", "bronze_yearly_value",
        "silver_quarter_count", "silver_yearly_value", "gold_yearly_value",
        gap(value["bronze"], value["silver"], 3).alias("bronze_vs_silver_diff"),
        gap(value["silver"], value["gold"], 3).alias("silver_vs_gold_diff"),
        gap(value["bronze"], value["gold"], 3).alias("bronze_vs_gold_diff"),
    )


def enrichment_trace(cases: DataFrame, bronze_obs: DataFrame, bronze_lookup: DataFrame, silver_obs: DataFrame,
                     generic: DataFrame, specific: DataFrame) -> DataFrame:
    """Value and looked-up measure of one series and period in every layer, per case year.

    ``cases`` has test_case, test_name and year; every other frame has one row per year.
    """
    def layer(df: DataFrame, **columns: str) -> DataFrame:
        return df.select("year", *[F.col(source).alias(target) for target, source in columns.items()])

    traced = cases
    for part in (
        layer(bronze_obs, bronze_bls_value="value"),
        layer(bronze_lookup, bronze_population="population"),
        layer(silver_obs, silver_bls_value="value"),
        layer(generic, generic_table_gold_value="value", generic_gold_population="population"),
        layer(specific, specific_table_gold_value="value", specific_gold_population="population"),
    ):
        traced = traced.join(part, "year", "left")
    col = F.col
    return traced.select(
        "test_case", "test_name", "year",
        "bronze_bls_value", "silver_bls_value", "generic_table_gold_value", "specific_table_gold_value",
        "bronze_population", "generic_gold_population", "specific_gold_population",
        gap(col("bronze_bls_value"), col("silver_bls_value")).alias("bronze_vs_silver_value_diff"),
        gap(col("silver_bls_value"), col("generic_table_gold_value")).alias("silver_vs_generic_table_gold_value_diff"),
        gap(col("generic_table_gold_value"), col("specific_table_gold_value"))
        .alias("generic_vs_specific_table_gold_value_diff"),
        gap_or_zero(col("bronze_population"), col("generic_gold_population"))
        .alias("bronze_vs_generic_gold_population_diff"),
        gap_or_zero(col("generic_gold_population"), col("specific_gold_population"))
        .alias("generic_vs_specific_gold_population_diff"),
    )
