"""Yearly values, best years and statistics against plain Python."""

import random
import statistics
from decimal import Decimal

import pytest

from strata.operators import rollup

SCHEMA = "series_id string, year int, period string, value decimal(18,3)"


def D(text):
    return None if text is None else Decimal(text)


def yearly(rows, data, incomplete="keep"):
    frame = rows([(s, y, p, D(v)) for s, y, p, v in data], SCHEMA)
    return rollup.yearly_values(rollup.yearly_rollup(frame), incomplete)


def expected_value(observations, incomplete):
    quarters = [(p, v) for p, v in observations if p in rollup.QUARTERS]
    annual = [v for p, v in observations if p == "Q05"]
    distinct = len({p for p, _ in quarters})
    if (distinct == 4) if incomplete == "exclude" else distinct:
        values = [v for _, v in quarters if v is not None]
        return sum(values, Decimal(0)) if values else None
    if not distinct and len(annual) == 1:
        return annual[0]
    return None


@pytest.mark.parametrize("incomplete", ["keep", "exclude"])
def test_values_and_best_years_agree_with_brute_force(rows, incomplete):
    rng = random.Random(7)
    data = []
    for series in range(40):
        for year in range(2000, 2006):
            for _ in range(rng.randint(1, 5)):
                period = rng.choice(["Q01", "Q02", "Q03", "Q04", "Q05", "Q05", "Q06", None])
                value = rng.choice([None, "0", "1.5", "-2.25", "3"])
                data.append((f"s{series}", year, period, value))
    groups = {}
    for series, year, period, value in data:
        groups.setdefault((series, year), []).append((period, D(value)))
    wanted = {key: expected_value(obs, incomplete) for key, obs in groups.items()}

    frame = yearly(rows, data, incomplete)
    assert {(r.series_id, r.year): r.yearly_value for r in frame.collect()} == wanted

    tops = {}
    for (series, year), value in wanted.items():
        if value is not None:
            tops.setdefault(series, []).append((value, year))
    best = {(s, y) for s, found in tops.items() for v, y in found if v == max(found)[0]}
    for choose in (rollup.best_period, rollup.best_period_by_dense_rank):
        assert {(r.series_id, r.year) for r in choose(frame).collect()} == best


def test_flags(rows):
    flagged = {
        r.year: r
        for r in yearly(rows, [
            ("s", 1, "Q01", "1"), ("s", 1, "Q02", "1"), ("s", 1, "Q03", "1"), ("s", 1, "Q04", "1"), ("s", 1, "Q05", "9"),
            ("s", 2, "Q01", "1"), ("s", 2, "Q01", "2"),
            ("s", 3, "Q05", "4"),
            ("s", 4, "Q05", "4"), ("s", 4, "Q05", "5"),
            ("s", 5, "Q06", "4"),
            ("s", 6, None, "4"), ("s", 6, "Q05", "1"),
        ]).collect()
    }
    complete = {y: r._all_four_quarters_or_annual_only for y, r in flagged.items()}
    usable = {y: r._has_usable_yearly_value for y, r in flagged.items()}
    known = {y: r._recognized_periods_only for y, r in flagged.items()}
    assert complete == {1: True, 2: False, 3: True, 4: False, 5: False, 6: True}
    assert usable == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True}
    assert known == {1: True, 2: True, 3: True, 4: True, 5: False, 6: True}
    assert flagged[1].yearly_value == Decimal("4.000") and flagged[1].value_method == "sum_available_quarters"
    assert flagged[2].quarter_count == 1 and flagged[2].yearly_value == Decimal("3.000")
    assert flagged[4].value_method is None


def test_unknown_mode_is_refused(rows):
    with pytest.raises(ValueError):
        yearly(rows, [("s", 1, "Q01", "1")], "maybe")


def test_a_series_holding_most_rows_is_merged_before_the_exchange(spark):
    obs = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, concat('s', id), 'hot') AS series_id", "cast(2000 + id % 7 AS int) AS year",
        "concat('Q0', 1 + id % 4) AS period", "cast(1 AS decimal(18,3)) AS value")
    best = rollup.best_period(rollup.yearly_values(rollup.yearly_rollup(obs)))
    total = obs.where("series_id = 'hot'").groupBy("year").count().agg({"count": "max"}).first()[0]
    assert {r.yearly_value for r in best.where("series_id = 'hot'").collect()} == {Decimal(f"{total}.000")}


STATS = "nation_id string, nation string, year int, population double"


def test_range_stats(rows):
    values = {2012: 1.0, 2013: 10.0, 2014: 13.0, 2018: 19.0, 2019: 99.0}
    frame = rows([("n", "N", y, v) for y, v in values.items()], STATS)
    row = rollup.range_stats(frame, 2013, 2018).first()
    inside = [v for y, v in values.items() if 2013 <= y <= 2018]
    assert tuple(row)[:4] == ("n", "N", 2013, 2018)
    assert row.mean_population == pytest.approx(statistics.mean(inside))
    assert row.stddev_population == pytest.approx(statistics.stdev(inside))
    assert rollup.range_stats_grouped(frame, 2013, 2018).first().year_count == 3


def test_range_stats_of_nothing(rows):
    frame = rows([("n", "N", 2000, 1.0)], STATS)
    assert [tuple(r) for r in rollup.range_stats(frame, 2013, 2018).collect()] == [(None, None, 2013, 2018, None, None)]
    assert rollup.range_stats_grouped(frame, 2013, 2018).isEmpty()
    one = rollup.range_stats(frame, 2000, 2000).first()
    assert (one.mean_population, one.stddev_population) == (1.0, None)
