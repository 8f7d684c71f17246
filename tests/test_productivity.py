"""From landed files to the three answers, with published figures as the measure."""

import json
import uuid
from dataclasses import replace
from decimal import Decimal

import pytest

from strata.operators.present import render_rows, sort_if_present, table_head
from strata.operators.quality import GateError
from strata.plans import productivity as plan

# Published yearly populations of the United States.
POPULATION = {
    2013: 316128839, 2014: 318857056, 2015: 321418821, 2016: 323127515, 2017: 325719178, 2018: 327167439,
    2019: 328239523, 2021: 331893745,
}
HEAD = {name: "\t".join(f" {c.upper()} " for c in contract.columns) for name, contract in plan.CONTRACTS.items()}
DIMENSIONS = {
    "pr.sector": ["3000\tManufacturing\t0\tT\t1"],
    "pr.class": ["6\tAll workers\t0\tT\t1"],
    "pr.measure": ["01\tEmployment\t0\tT\t1", "03\tHours\t0\tT\t2"],
    "pr.duration": ["1\t% Change same quarter 1 year ago\t0\tT\t1"],
    "pr.seasonal": ["S\tSeasonal Adjusted"],
    "pr.period": ["Q01\tQTR1\t1st Quarter"],
    "pr.footnote": ["r\trevised"],
    "pr.series": [
        "PRS30006011 \t3000\t6\t01\t1\tS\t-\t\t1995\tQ01\t1996\tQ02",
        "PRS30006032 \t3000\t6\t03\t1\tS\t2017\t\t2012\tQ01\t2018\tQ01",
        "PRS30006081 \t3000\t6\t99\t1\tS\t2017\t\t2020\tQ05\t2022\tQ05",
    ],
}
FACTS = [
    ("PRS30006011", 1995, "Q01", "1"), ("PRS30006011", 1995, "Q02", "2"), ("PRS30006011", 1995, "Q05", "90"),
    ("PRS30006011", 1996, "Q01", "3"), ("PRS30006011", 1996, "Q02", "4"),
    ("PRS30006032", 2012, "Q01", "2.5"), ("PRS30006032", 2013, "Q01", "0.5"), ("PRS30006032", 2018, "Q01", "2.500"),
    ("PRS30006081", 2020, "Q05", "7.25"), ("PRS30006081", 2021, "Q05", "24.5"), ("PRS30006081", 2022, "Q05", "6"),
]


def land_text(folder, facts):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{s}   \t{y}\t{p}\t{v:>12}\t" for s, y, p, v in facts]
    for name in ("pr.data.0.Current", "pr.data.1.AllData"):
        (folder / name).write_text("\n".join([HEAD[name], *lines]) + "\n")
    for name, rows in DIMENSIONS.items():
        (folder / name).write_text("\n".join([HEAD[name], *rows]) + "\n")
    (folder / "pr.txt").write_text("a description, not a table\n")
    (folder / "pr.new-Things").write_text("code\ttext\n1\tone\n")


def land_population(folder, when, body):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"population__fetched_{when}_UTC.json").write_text(body)


def body_of(values):
    records = [{"Nation ID": "01000US", "Nation": "United States", "Year": y, "Population": float(p)}
               for y, p in values.items()]
    return json.dumps({"annotations": {"source": "x"}, "data": records, "page": {"total": len(records)}})


def landed(root, prefix):
    land_text(root / "text", FACTS)
    land_population(root / "population", "2026-01-01__10_00_00", body_of({2013: 1, 2014: 2}))
    land_population(root / "population", "2026-01-02__09_30_00", body_of(POPULATION))
    return plan.Layout(str(root / "text"), str(root / "population"), str(root / "warehouse"),
                       f"{prefix}_bronze", f"{prefix}_silver", f"{prefix}_gold")


@pytest.fixture
def layout(tmp_path):
    return landed(tmp_path, f"t{uuid.uuid4().hex[:12]}")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All layers built once, with the outcomes of their rules."""
    made = landed(tmp_path_factory.mktemp("built"), "built")
    return made, plan.build(spark, made)


def test_three_answers(spark, built):
    layout, outcomes = built
    table = lambda name: spark.table(f"{layout.gold}.{name}")

    stats = table("population_summary_stats").collect()
    assert [tuple(r)[:5] for r in stats] == [("01000US", "United States", 2013, 2018, 322069808.0)]
    # The last digits of a deviation depend on the order in which partial results are merged.
    assert stats[0].stddev_population == pytest.approx(4158441.040908095, rel=1e-14)
    by_sql = table("population_summary_sql_alternative").drop("year_count").collect()
    assert by_sql[0].mean_population == 322069808.0

    best = table("bls_series_best_year")
    assert {(r.series_id, r.best_year, r.yearly_value, r.value_method) for r in best.collect()} == {
        ("PRS30006011", 1996, Decimal("7.000"), "sum_available_quarters"),
        ("PRS30006032", 2012, Decimal("2.500"), "sum_available_quarters"),
        ("PRS30006032", 2018, Decimal("2.500"), "sum_available_quarters"),
        ("PRS30006081", 2021, Decimal("24.500"), "annual_average_q05"),
    }
    labels = {r.series_id: (r.human_readable_label, r._label_lookup_complete) for r in best.collect()}
    assert labels["PRS30006011"] == (
        "Manufacturing | Employment | All workers | % Change same quarter 1 year ago | Seasonal Adjusted", True)
    assert labels["PRS30006081"] == ("Manufacturing | All workers | % Change same quarter 1 year ago | Seasonal Adjusted", False)
    warned = {o.name: o.violations for o in outcomes["bls_series_best_year"]}
    assert warned == {"human_readable_label_lookup_complete": 1}

    strict = table("bls_series_best_year_sql_alternative").collect()
    assert [(r.series_id, r.best_year, r.human_readable_label is not None) for r in strict] == [("PRS30006081", 2021, True)]

    answer = table("bls_prs30006032_q01_population_by_year").orderBy("year").collect()
    assert [(r.year, r.value, r.population) for r in answer] == [
        (2012, Decimal("2.500"), None), (2013, Decimal("0.500"), 316128839.0), (2018, Decimal("2.500"), 327167439.0)]
    twin = table("bls_prs30006032_q01_population_by_year_sql_alternative")
    assert twin.exceptAll(table("bls_prs30006032_q01_population_by_year")).isEmpty()
    assert table("bls_series_period_population_by_year").count() == len(FACTS)

    flags = spark.table(f"{layout.bronze}.bls_pr_new_things").select("_expected_schema_valid", "_non_null_key_valid")
    assert [tuple(r) for r in flags.collect()] == [(False, False)]
    assert spark.table(f"{layout.bronze}.population_raw").count() == 2


def test_report_lines_look_like_the_published_ones(spark, built):
    layout, _ = built
    stats = spark.table(f"{layout.gold}.population_summary_stats")
    assert table_head(stats) == (
        "| nation_id | nation | start_year | end_year | mean_population | stddev_population |\n"
        "| --- | --- | --- | --- | --- | --- |")
    lines = [r.line for r in render_rows(sort_if_present(stats, ["year"])).collect()]
    assert lines == [f"| 01000US | United States | 2013 | 2018 | 322069808.0 | {stats.first().stddev_population} |"]
    best = sort_if_present(spark.table(f"{layout.gold}.bls_series_best_year"), ["series_id", "best_year", "year"])
    first = render_rows(best.select("series_id", "best_year", "yearly_value", "human_readable_label",
                                    "_label_lookup_complete")).first().line
    assert first == (r"| PRS30006011 | 1996 | 7.000 | Manufacturing \| Employment \| All workers \| "
                     r"% Change same quarter 1 year ago \| Seasonal Adjusted | True |")


def create_schemas(spark, layout):
    for schema in (layout.bronze, layout.silver, layout.gold):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def test_only_new_snapshots_are_ingested_and_the_newest_counts(spark, layout, tmp_path):
    create_schemas(spark, layout)
    assert {o.checked for o in plan.population_bronze(spark, layout)} == {2}
    assert plan.population_silver(spark, layout).data.count() == len(POPULATION)
    land_population(tmp_path / "population", "2026-01-03__00_00_00", body_of({2013: 10, 2014: 20}))
    assert {o.checked for o in plan.population_bronze(spark, layout)} == {1}
    assert spark.table(f"{layout.bronze}.population_raw").count() == 3
    plan.population_silver(spark, layout)
    newest = spark.table(f"{layout.silver}.fct_population").collect()
    assert {(r.year, r.population, r.source_file) for r in newest} == {
        (2013, 10.0, "population__fetched_2026-01-03__00_00_00_UTC.json"),
        (2014, 20.0, "population__fetched_2026-01-03__00_00_00_UTC.json"),
    }


def test_broken_newest_snapshot_stops_without_falling_back(spark, layout, tmp_path):
    create_schemas(spark, layout)
    plan.population_bronze(spark, layout)
    plan.population_silver(spark, layout)
    land_population(tmp_path / "population", "2026-01-04__00_00_00", '{"data": [')
    warned = {o.name: o.violations for o in plan.population_bronze(spark, layout)}
    assert warned["expected_population_schema"] == 1 and warned["raw_json_not_null"] == 0
    with pytest.raises(GateError, match="nation_id_not_null=1"):
        plan.population_silver(spark, layout)
    assert spark.table(f"{layout.bronze}.population_raw").where("not payload_schema_valid").count() == 1
    assert spark.table(f"{layout.silver}.fct_population").count() == len(POPULATION)


def test_no_snapshot_yet(spark, layout, tmp_path):
    create_schemas(spark, layout)
    (tmp_path / "nothing").mkdir()
    early = replace(layout, population_folder=str(tmp_path / "nothing"))
    for _ in range(2):
        plan.population_bronze(spark, early)
        assert plan.population_silver(spark, early).data.isEmpty()
    land_population(tmp_path / "nothing", "2026-01-02__09_30_00", body_of(POPULATION))
    plan.population_bronze(spark, early)
    assert plan.population_silver(spark, early).data.count() == len(POPULATION)


def test_repeated_year_in_one_snapshot_stops_the_table(spark, layout, tmp_path):
    create_schemas(spark, layout)
    twice = json.loads(body_of({2013: 1}))
    twice["data"] *= 2
    land_population(tmp_path / "population", "2026-01-05__00_00_00", json.dumps(twice))
    plan.population_bronze(spark, layout)
    with pytest.raises(GateError, match="unique_nation_year=2"):
        plan.population_silver(spark, layout)


def test_bad_facts_leave_the_typed_table_on_its_last_version(spark, layout, tmp_path):
    create_schemas(spark, layout)
    plan.text_bronze(spark, layout)
    plan.text_silver(spark, layout)
    bad = {
        "value_not_null=1": ("PRS30006011", 1996, "Q03", "n/a"),
        "unique_natural_key=2": ("PRS30006011", 1996, "Q01", "8"),
    }
    for rule, fact in bad.items():
        land_text(tmp_path / "text", [*FACTS, fact])
        plan.text_bronze(spark, layout)
        with pytest.raises(GateError, match=rule):
            plan.text_silver(spark, layout)
        assert spark.table(f"{layout.silver}.fct_bls_pr_data_1_alldata").count() == len(FACTS)


def test_unknown_period_stops_the_yearly_values(spark, layout, tmp_path):
    create_schemas(spark, layout)
    land_text(tmp_path / "text", [*FACTS, ("PRS30006011", 1996, "Q06", "8")])
    plan.text_bronze(spark, layout)
    plan.text_silver(spark, layout)
    plan.population_bronze(spark, layout)
    plan.population_silver(spark, layout)
    with pytest.raises(GateError, match="recognized_period_codes_only=1"):
        plan.gold(spark, layout)
