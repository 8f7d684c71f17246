"""Lookups and comparisons."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import compare, enrich, present
from strata.operators.enrich import AmbiguousLookup
from strata.plans.answers import observations_with_population


def test_label_lookup(rows):
    coded = rows([("s1", "a", 1), ("s2", "z", 1), ("s3", None, 9)], "id string, x string, y int")
    xs = rows([("a", "Alpha")], "code string, x_text string")
    ys = rows([(1, "One"), (2, "Two")], "code int, y_text string")
    found = enrich.label_lookup(
        coded, "id", [enrich.Lookup(xs, "code", "x_text", "x"), enrich.Lookup(ys, "code", "y_text", "y")],
        ["y_text", "x_text"])
    assert {tuple(r) for r in found.collect()} == {
        ("s1", "Alpha", "One", True, "One | Alpha"), ("s2", None, "One", False, "One"), ("s3", None, None, False, "")}


def test_enrich_keeps_facts_and_can_insist_on_a_unique_lookup(rows):
    facts = rows([(1, 2000), (2, 2001), (3, None)], "id int, year int")
    lookup = rows([(2000, 5.0)], "year bigint, population double")
    found = enrich.enrich(facts, lookup, "year")
    assert found.columns == ["id", "year", "population"]
    assert {tuple(r) for r in found.collect()} == {(1, 2000, 5.0), (2, 2001, None), (3, None, None)}
    doubled = lookup.unionByName(lookup)
    assert enrich.enrich(facts, doubled, "year").count() == 4
    with pytest.raises(enrich.AmbiguousLookup):
        enrich.enrich(facts, doubled, "year", expect_unique=True)


def test_unmatched(rows):
    lookup = rows([(2000,), (2001,), (None,)], "year int")
    facts = rows([(2000,), (2000,)], "year int")
    assert {r.year for r in enrich.unmatched(lookup, facts, "year").collect()} == {2001, None}


SIDES = "k string, v int"


def test_two_way_diff_is_except_in_both_directions(rows):
    left = rows([("a", 1), ("a", 1), ("b", None), ("c", 3)], SIDES)
    right = rows([("b", None), ("c", 4), ("d", 5), ("d", 5)], SIDES).select("v", "k")
    found = compare.two_way_diff(left, right, "left", "right")
    assert {tuple(r) for r in found.collect()} == {("left", "a", 1), ("left", "c", 3), ("right", "c", 4), ("right", "d", 5)}
    assert found.count() == 4
    by_except = {("left", *r) for r in left.subtract(right.select("k", "v")).collect()} | {
        ("right", *r) for r in right.select("k", "v").subtract(left).collect()}
    assert {tuple(r) for r in found.collect()} == by_except
    assert [tuple(r) for r in compare.diff_counts(left, right, "l", "r").collect()] == [("l", 2), ("r", 2)]
    assert [tuple(r) for r in compare.diff_counts(left, left, "l", "r").collect()] == [("l", 0), ("r", 0)]


def test_layer_trace_shows_a_gap(rows):
    obs = [("s", 2000, f"Q0{q}", Decimal(q)) for q in (1, 2, 3, 4)] + [("t", 2000, "Q05", Decimal(7))]
    silver = rows(obs, "series_id string, year int, period string, value decimal(18,3)")
    bronze = rows([(f" {s} ", str(y), p, "9" if p == "Q04" else str(v)) for s, y, p, v in obs],
                  "series_id string, year string, period string, value string")
    gold = rows([("s", 2000, Decimal(10))], "series_id string, best_year int, yearly_value decimal(28,3)")
    cases = rows([("one", "s", 2000), ("two", "t", 2000), ("none", "u", 2000)],
                 "test_case string, series_id string, year int")
    traced = {r.test_case: r for r in compare.layer_trace(cases, bronze, silver, gold).collect()}
    assert set(traced) == {"one", "two"}
    assert (traced["one"].bronze_vs_silver_diff, traced["one"].silver_vs_gold_diff) == (5.0, Decimal("0.000"))
    assert (traced["two"].bronze_yearly_value, traced["two"].gold_yearly_value) == (7.0, None)
    assert traced["two"].silver_vs_gold_diff is None


def test_enrichment_trace_shows_gaps(rows):
    years = "year int, value decimal(18,3), population bigint"
    bronze = rows([(2000, 1.0), (2001, 2.0)], "year int, value double")
    people = rows([(2000, 10), (2002, 30)], "year int, population bigint")
    silver = rows([(2000, Decimal("1.500")), (2001, Decimal(2))], "year int, value decimal(18,3)")
    generic = rows([(2000, Decimal("1.500"), 10), (2001, Decimal(2), None)], years)
    specific = rows([(2000, Decimal("1.125"), 13)], years)
    cases = rows([("a", "both", 2000), ("b", "stale", 2001), ("c", "people", 2002)], "test_case string, test_name string, year int")
    found = {r.test_case: r for r in compare.enrichment_trace(cases, bronze, people, silver, generic, specific).collect()}
    a, b, c = found["a"], found["b"], found["c"]
    assert a.bronze_vs_silver_value_diff == 0.5 and a.silver_vs_generic_table_gold_value_diff == 0
    assert float(a.generic_vs_specific_table_gold_value_diff) == 0.375 and a.generic_vs_specific_gold_population_diff == 3
    assert b.generic_vs_specific_table_gold_value_diff is None and b.generic_vs_specific_gold_population_diff == 0
    assert c.bronze_vs_generic_gold_population_diff is None and c.bronze_vs_silver_value_diff is None


def test_two_nations_of_one_year_stop_the_enriched_table(rows):
    obs = rows([("s", "Q01", 2000, Decimal(1))], "series_id string, period string, year int, value decimal(18,3)")
    people = rows([(2000, 1.0), (2000, 2.0)], "year int, population double")
    with pytest.raises(AmbiguousLookup):
        observations_with_population(obs, people, expect_unique=True)


def test_sort_if_present(rows):
    frame = rows([(2, "a"), (1, "b"), (1, "a")], "n int, t string").withColumn("m", F.create_map(F.lit("k"), "n"))
    assert [(r.n, r.t) for r in present.sort_if_present(frame, ["missing", "n"]).collect()] == [(1, "a"), (1, "b"), (2, "a")]
    assert present.sort_if_present(frame, ["missing"]) is frame


def test_table_head(rows):
    assert present.table_head(rows([], "a int, `b|c` int")) == "| a | b\\|c |\n| --- | --- |"
