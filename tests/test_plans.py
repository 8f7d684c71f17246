"""The physical plans behind the claims about large data."""

import pytest
from pyspark.sql import functions as F

from strata.operators import compare, enrich, rollup, snapshots
from strata.operators.quality import expect_report, flag_unique_key
from strata.plans.answers import YEARLY_RULES, observations_with_population, one_series_and_period, series_years
from strata.sources.listing import page_links


def plan_of(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Observations, yearly populations and daily snapshots as parquet."""
    root = str(tmp_path_factory.mktemp("plans"))
    spark.range(20_000).selectExpr(
        "concat('s', id % 1000) AS series_id", "cast(2000 + id % 7 AS int) AS year", "concat('Q0', 1 + id % 5) AS period",
        "cast(id AS decimal(18,3)) AS value", "repeat('x', 50) AS unused",
    ).write.parquet(f"{root}/obs")
    spark.range(7).selectExpr("2000 + id AS year", "cast(id AS double) AS population").write.parquet(f"{root}/population")
    spark.range(20).selectExpr(
        "date_add(date '2026-01-01', cast(id div 2 AS int)) AS fetched_on",
        "timestamp '2026-01-01' + make_interval(0, 0, 0, cast(id div 2 AS int)) AS fetched_at_utc", "repeat('x', 50) AS raw_json",
    ).write.partitionBy("fetched_on").parquet(f"{root}/raw")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def test_rollup_is_one_exchange_over_the_needed_columns(stored):
    plan = plan_of(series_years(stored("obs")))
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan
    assert "ReadSchema: struct<series_id:string,year:int,period:string,value:decimal(18,3)>" in plan


def test_best_years_are_cut_before_the_exchange(stored):
    plan = plan_of(rollup.best_period(series_years(stored("obs"))))
    assert plan.count("WindowGroupLimit") == 2 and "SinglePartition" not in plan


def test_a_report_scans_once(stored):
    assert plan_of(expect_report(series_years(stored("obs")), YEARLY_RULES)).count("FileScan") == 1


def test_newest_snapshot_prunes_folders_and_shuffles_no_body(stored):
    newest = snapshots.latest_snapshot(stored("raw"), partition="fetched_on")
    assert newest.count() == 2
    main = plan_of(newest).split("Subquery")[0]
    assert "Exchange" not in main
    assert "PartitionFilters: [isnotnull(fetched_on" in plan_of(newest)


def test_year_bounds_and_the_newest_day_reach_the_scan(spark, stored):
    days = stored("raw").select("fetched_at_utc", F.lit("n").alias("nation_id"), F.lit("m").alias("nation"), F.lit(1.0).alias("population"))
    plan = plan_of(rollup.range_stats(days, 2025, 2026, day="fetched_at_utc"))
    assert "GreaterThanOrEqual(fetched_at_utc" in plan
    newest = snapshots.latest_snapshot(stored("raw").drop("fetched_on"), unit="day")
    assert newest.count() == 2
    assert "DataFilters: [isnotnull(fetched_at_utc" in plan_of(newest)


def test_a_body_is_parsed_once(rows):
    frame = rows([(1, '{"data": [{"Year": 1}]}')], "k int, raw_json string")
    flagged = snapshots.flag_parsed(snapshots.parse_payload(frame, "data array<struct<Year: bigint>>"))
    assert plan_of(flagged.drop("_records")).count("from_json") == 1


def test_series_and_period_reach_the_scan_and_the_lookup_is_broadcast(stored):
    chosen = one_series_and_period(observations_with_population(stored("obs"), stored("population")), "s5", "Q01")
    plan = plan_of(chosen)
    assert "EqualTo(series_id,s5)" in plan and "EqualTo(period,Q01)" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "unused" not in plan


def test_unique_keys_do_not_shuffle_the_rows(stored):
    flagged = flag_unique_key(stored("obs"), ["series_id", "year", "period", "value"])
    plan = plan_of(flagged)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_links_are_found_without_a_shuffle(spark):
    pages = spark.range(10).selectExpr("id AS page_id", "'http://e.org/' AS url", """'<a href="x">x</a>' AS html""")
    assert "Exchange" not in plan_of(page_links(pages))


def test_two_way_difference_reads_each_side_once(stored):
    left, right = stored("obs").drop("unused"), stored("obs").drop("unused").where("year > 2001")
    plan = plan_of(compare.two_way_diff(left, right, "l", "r"))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_lookup_key_shared_by_most_facts_is_split(spark):
    """With broadcasts ruled out AQE divides the partition of the hot year."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 2 = 0, 0, id) AS year", "uuid() AS fact")
        lookup = spark.range(0, 100_000, 1, 2).selectExpr("id AS year", "id * 1.0 AS population")
        found = enrich.enrich(facts, lookup, "year")
        assert "skew=true" in plan_of(found, executed=True)
        assert found.agg(F.count("*"), F.count("population")).first()[:] == (200_000, 150_000)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
