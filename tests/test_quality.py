"""Contracts, typing, expectations, unique keys and publishing."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import conform, contracts, publish, quality

Rule = quality.Expectation


def test_contract_flags(rows):
    contract = contracts.Contract.of("a b", "a")
    frame = rows([("1", "x"), ("  ", "x"), (None, "x")], "a string, b string")
    flagged = contracts.flag_contract(frame, contract)
    assert [(r._expected_schema_valid, r._non_null_key_valid) for r in flagged.collect()] == [
        (True, True), (True, False), (True, False)]
    swapped = contracts.flag_contract(frame.select("b", "a"), contract).first()
    assert (swapped._expected_schema_valid, swapped._non_null_key_valid) == (False, True)
    keyless = contracts.flag_contract(frame.select("b"), contract).first()
    assert (keyless._expected_schema_valid, keyless._non_null_key_valid) == (False, False)
    unknown = contracts.flag_contract(frame, None).first()
    assert (unknown._expected_schema_valid, unknown._non_null_key_valid) == (False, False)


def test_conform_trims_types_renames_and_drops(rows):
    spec = conform.ConformSpec.of("s", "t", "code year:int season>season_code v:decimal(18,3)", "code", "code v")
    raw = rows([(" 01 ", " 2020 ", "S", " 1.23456 ", "x"), ("02", "20x", None, "", "x"), ("03", "9999999999", "", "1e3", "x")],
               "code string, year string, season string, v string, extra string")
    typed = conform.conform(raw, spec)
    assert typed.columns == ["code", "year", "season_code", "v"]
    assert [tuple(r) for r in typed.collect()] == [
        ("01", 2020, "S", Decimal("1.235")), ("02", None, None, None), ("03", None, "", Decimal("1000.000"))]
    assert [(r.name, r.mode) for r in conform.conform_rules(spec)] == [
        ("code_not_null", "fail"), ("v_not_null", "fail"), ("unique_natural_key", "fail")]


def test_conform_all_builds_one_frame_per_specification(rows):
    specs = [conform.ConformSpec.of("a", "dim_a", "k", "k"), conform.ConformSpec.of("b", "dim_b", "k n:int", "k n")]
    frames = {"a": rows([("x",), ("x",)], "k string"), "b": rows([("x", "1"), ("x", "2")], "k string, n string")}
    built = conform.conform_all(frames.__getitem__, specs)
    assert [r._natural_key_unique for r in built["dim_a"].collect()] == [False, False]
    assert [r._natural_key_unique for r in built["dim_b"].collect()] == [True, True]


def test_null_outcome_is_a_violation(rows):
    frame = rows([(1,), (None,), (-1,)], "n int")
    rules = [Rule("positive", "n > 0"), Rule("known", "n IS NOT NULL", "fail")]
    assert [tuple(r) for r in quality.expect_report(frame, rules).collect()] == [
        ("positive", "warn", 3, 2), ("known", "fail", 3, 1)]
    assert [(r.n, r._violated) for r in quality.expect_rows(frame, rules).collect()] == [
        (None, ["positive", "known"]), (-1, ["positive"])]
    assert [len(r._violated) for r in quality.flag_violations(frame, rules).collect()] == [0, 2, 1]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        Rule("x", "true", "drop")


KEYED = "k string, n int, payload string"


def by_window(frame, keys):
    count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return sorted(map(str, frame.withColumn("_natural_key_unique", count == 1).collect()))


def test_unique_key_flag_compares_nulls_as_equal(rows):
    frame = rows([("a", 1, "p"), ("a", 1, "q"), ("a", 2, "p"), (None, 1, "p"), (None, 1, "p"), ("b", None, "p")], KEYED)
    flagged = quality.flag_unique_key(frame, ["k", "n"])
    assert flagged.columns == ["k", "n", "payload", "_natural_key_unique"]
    assert sorted(map(str, flagged.collect())) == by_window(frame, ["k", "n"])


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_unique_key_flag_with_a_hot_key(spark, broadcast):
    """One key holds half the rows; with broadcasts off the join splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 2 = 0, 0, id div 3) AS k", "id", "repeat('x', 20) AS t")
        flagged = quality.flag_unique_key(frame, ["k"])
        flagged.collect()
        final_plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in final_plan if broadcast != "-1" else "skew=true" in final_plan
        counts = {r._natural_key_unique: r["count"] for r in flagged.groupBy("_natural_key_unique").count().collect()}
        wanted = frame.groupBy("k").count().agg(F.expr("count_if(count = 1)"), F.sum(F.when(F.col("count") > 1, F.col("count"))))
        assert (counts[True], counts[False]) == tuple(wanted.first())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_publish_switches_the_view_only_when_the_rules_hold(spark, rows, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS gate")
    rules = [Rule("filled", "n IS NOT NULL", "fail"), Rule("large", "n > 1")]
    place = str(tmp_path / "t")
    first = publish.publish(rows([(1,), (2,)], "n int"), place, rules, "gate.t", "It's a \\ comment")
    assert [(o.name, o.violations) for o in first.warnings] == [("large", 1)]
    assert sorted(r.n for r in spark.table("gate.t").collect()) == [1, 2]

    with pytest.raises(quality.GateError) as stopped:
        publish.publish(rows([(3,), (None,)], "n int"), place, rules, "gate.t")
    assert {o.name: o.violations for o in stopped.value.outcomes} == {"filled": 1, "large": 1}
    assert sorted(r.n for r in spark.table("gate.t").collect()) == [1, 2]

    second = publish.publish(rows([(5, "x")], "n int, more string"), place, rules, "gate.t")
    assert [tuple(r) for r in spark.table("gate.t").collect()] == [(5, "x")]
    assert sorted(r.n for r in first.data.collect()) == [1, 2] and second.path != first.path

    grown = spark.table("gate.t").union(rows([(6, "y")], "n int, more string"))
    third = publish.publish(grown, place, rules, "gate.t")
    assert sorted(r.n for r in spark.table("gate.t").collect()) == [5, 6]
    assert len({first.path, second.path, third.path}) == 3


def test_readers_of_old_versions_and_removal_by_age(spark, rows, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS gate")
    place = str(tmp_path / "v")
    publish.publish(rows([(1,)], "n int"), place, (), "gate.v")
    reader = spark.table("gate.v")
    reader.schema
    for n in (2, 3):
        publish.publish(rows([(n,)], "n int"), place, (), "gate.v")
    assert [r.n for r in reader.collect()] == [1]
    assert publish.remove_versions(spark, place, "gate.v", datetime.now(timezone.utc) - timedelta(days=1)) == []
    assert len(publish.remove_versions(spark, place, "gate.v", datetime.now(timezone.utc) + timedelta(days=1))) == 2
    assert [r.n for r in spark.table("gate.v").collect()] == [3]


def test_a_filter_behind_the_gate_hides_nothing(spark, rows, tmp_path):
    """The gate sees the whole set even if only clean rows are read later."""
    frame = rows([(1, "a"), (2, None)], "k int, v string")
    with pytest.raises(quality.GateError):
        publish.gated_view(frame, str(tmp_path / "t"), [Rule("filled", "v IS NOT NULL", "fail")], "gated").data.where("k = 1")


def test_publish_of_an_empty_frame_and_of_partitions(spark, rows, tmp_path):
    empty = publish.publish(rows([], "n int"), str(tmp_path / "e"), [Rule("filled", "n IS NOT NULL", "fail")])
    assert empty.data.isEmpty() and [(o.checked, o.violations) for o in empty.outcomes] == [(0, 0)]
    parts = publish.publish(rows([(1, "a"), (2, "b")], "n int, p string"), str(tmp_path / "p"), partition_by=["p"])
    assert sorted((r.n, r.p) for r in parts.data.collect()) == [(1, "a"), (2, "b")]
    none = publish.publish(rows([], "n int, p string"), str(tmp_path / "n"), partition_by=["p"])
    assert none.data.isEmpty() and none.data.columns == ["n", "p"]


def test_a_version_without_files_keeps_odd_names(spark, rows, tmp_path):
    """Blanks, dots and backticks in names, nested ones too; the view has the columns although no file was written."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS gate")
    schema = "`a b` array<struct<`Nation ID`: string, `x.y`: map<string, decimal(5,2)>>>, `c.``d` timestamp, p string"
    none = publish.publish(rows([], schema), str(tmp_path / "odd"), (), "gate.odd", partition_by=["p"])
    assert spark.table("gate.odd").schema.simpleString() == none.data.schema.simpleString() == rows([], schema).schema.simpleString()
    assert spark.table("gate.odd").isEmpty()


def test_a_snapshot_lands_once(rows, spark, tmp_path):
    frame = rows([(1,)], "n int")
    path = publish.append_snapshot(frame, str(tmp_path), "fetched-1")
    with pytest.raises(Exception, match="(?i)already exists"):
        publish.append_snapshot(frame, str(tmp_path), "fetched-1")
    assert spark.read.parquet(path).count() == 1


def test_log_grows(rows, spark, tmp_path):
    for n in (1, 2):
        publish.append_rows(rows([(n,)], "n int"), str(tmp_path / "log"))
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "log")).collect()) == [1, 2]
