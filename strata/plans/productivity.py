"""Labour productivity and population: from landed files to the three answers.

Layers are catalog schemas holding views on published versions; each dataset is checked
while it is written (see :mod:`strata.operators.publish`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import SnapshotName
from strata.functions.text import normalize_name
from strata.operators.conform import LINEAGE, ConformSpec, conform_checked, conform_rules
from strata.operators.contracts import KEY_FLAG, SCHEMA_FLAG, Contract
from strata.operators.enrich import Lookup, one_per_key
from strata.operators.publish import Published, gated_view, publish, quoted, stored_query
from strata.operators.quality import FAIL, WARN, Expectation, RuleOutcome, expect_all, expect_report, flag_unique_key
from strata.operators.rollup import range_stats
from strata.operators.snapshots import explode_parsed, flag_parsed, latest_snapshot, parse_payload, record_fields
from strata.plans import sql_twins
from strata.plans.answers import (
    LABEL_RULES,
    YEARLY_RULES,
    labelled_best_years,
    observations_with_population,
    one_series_and_period,
    series_years,
)
from strata.session import scratch_path
from strata.sources.folders import by_header, dataset_columns, land_lines
from strata.streaming.snapshots import identify, ingest_available, newest_ingested, snapshot_stream

# Layout of the source's text files (name, columns, key) and the files left out.
IGNORED_FILES = ("_directory_listing.html", "pr.contacts", "pr.txt")
CONTRACTS = {
    "pr.class": Contract.of("class_code class_text display_level selectable sort_sequence", "class_code"),
    "pr.data.0.Current": Contract.of("series_id year period value footnote_codes", "series_id year period"),
    "pr.data.1.AllData": Contract.of("series_id year period value footnote_codes", "series_id year period"),
    "pr.duration": Contract.of("duration_code duration_text display_level selectable sort_sequence", "duration_code"),
    "pr.footnote": Contract.of("footnote_code footnote_text", "footnote_code"),
    "pr.measure": Contract.of("measure_code measure_text display_level selectable sort_sequence", "measure_code"),
    "pr.period": Contract.of("period period_abbr period_name", "period"),
    "pr.seasonal": Contract.of("seasonal_code seasonal_text", "seasonal_code"),
    "pr.sector": Contract.of("sector_code sector_name display_level selectable sort_sequence", "sector_code"),
    "pr.series": Contract.of(
        "series_id sector_code class_code measure_code duration_code seasonal base_year footnote_codes "
        "begin_year begin_period end_year end_period",
        "series_id",
    ),
}

# Raw table, typed table and their columns as source[>target][:type]. Codes stay text.
_FACT = "series_id year:int period value:decimal(18,3) footnote_codes"
SPECS = (
    ConformSpec.of("bls_pr_data_0_current", "fct_bls_pr_data_0_current", _FACT, "series_id year period",
                   "series_id year period value", "Productivity observations of the current year."),
    ConformSpec.of("bls_pr_data_1_alldata", "fct_bls_pr_data_1_alldata", _FACT, "series_id year period",
                   "series_id year period value", "Productivity observations of all years."),
    ConformSpec.of("bls_pr_class", "dim_bls_pr_class",
                   "class_code class_text display_level:int selectable sort_sequence:int", "class_code",
                   comment="Texts of class codes."),
    ConformSpec.of("bls_pr_duration", "dim_bls_pr_duration",
                   "duration_code duration_text display_level:int selectable sort_sequence:int", "duration_code",
                   comment="Texts of duration codes."),
    ConformSpec.of("bls_pr_footnote", "dim_bls_pr_footnote", "footnote_code footnote_text", "footnote_code",
                   comment="Texts of footnote codes."),
    ConformSpec.of("bls_pr_measure", "dim_bls_pr_measure",
                   "measure_code measure_text display_level:int selectable sort_sequence:int", "measure_code",
                   comment="Texts of measure codes."),
    ConformSpec.of("bls_pr_period", "dim_bls_pr_period", "period period_abbr period_name", "period",
                   comment="Texts of period codes."),
    ConformSpec.of("bls_pr_seasonal", "dim_bls_pr_seasonal", "seasonal_code seasonal_text", "seasonal_code",
                   comment="Texts of seasonal adjustment codes."),
    ConformSpec.of("bls_pr_sector", "dim_bls_pr_sector",
                   "sector_code sector_name display_level:int selectable sort_sequence:int", "sector_code",
                   comment="Texts of sector codes."),
    ConformSpec.of("bls_pr_series", "dim_bls_pr_series",
                   "series_id sector_code class_code measure_code duration_code seasonal>seasonal_code base_year "
                   "footnote_codes begin_year:int begin_period end_year:int end_period", "series_id",
                   comment="Series and the codes that describe them."),
)

# File names and body of the population snapshots.
POPULATION_NAME = SnapshotName("population__fetched_", "_UTC.json")
POPULATION_GLOB = "population__fetched_*.json"
POPULATION_BODY = "data array<struct<`Nation ID`: string, Nation: string, Year: bigint, Population: double>>"
POPULATION_FIELDS = {"Nation ID": "nation_id", "Nation": "nation", "Year": "year", "Population": "population"}

# Names of the published rules.
TEXT_RULES = [Expectation("expected_schema", SCHEMA_FLAG, WARN), Expectation("non_null_key", KEY_FLAG, WARN)]
SNAPSHOT_RULES = [
    *expect_all({f"{c}_not_null": f"{c} IS NOT NULL" for c in ("source_file", "fetched_at_utc", "raw_json")}, FAIL),
    Expectation("expected_population_schema", "payload_schema_valid", WARN),
    Expectation("population_data_not_empty", "population_data_not_empty", WARN),
]
POPULATION_RULES = [
    *expect_all({f"{c}_not_null": f"{c} IS NOT NULL" for c in ("nation_id", "year", "population")}, FAIL),
    Expectation("unique_nation_year", "_natural_key_unique", FAIL),
]

#: Property of the raw population view: the last day that has snapshots, so that readers need not look for it.
NEWEST = "strata.newest"

FIRST_YEAR, LAST_YEAR = 2013, 2018
TARGET_SERIES, TARGET_PERIOD = "PRS30006032", "Q01"


@dataclass(frozen=True)
class Layout:
    """Where files land, where versions are kept and how the layers are called."""

    text_folder: str
    population_folder: str
    warehouse: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def location(self, view: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{view.replace('.', '/')}"

    @property
    def quality_log(self) -> str:
        return f"{self.warehouse.rstrip('/')}/quality_log"


Outcomes = dict[str, list[RuleOutcome]]


def _publish(layout: Layout, view: str, df: DataFrame, rules: Iterable[Expectation] = (), comment: str = "") -> Published:
    return publish(df, layout.location(view), list(rules), view, comment, log=layout.quality_log)


def _side_by_side(tasks: dict[str, Callable[[], Published]]) -> Outcomes:
    """Independent datasets as concurrent Spark jobs; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        started = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: future.result().outcomes for name, future in started.items()}


def text_bronze(spark: SparkSession, layout: Layout) -> Outcomes:
    """One raw table per landed text file, whatever files there are; unknown ones are flagged.

    All files are read, flagged and written together as one version, a folder per dataset; the number of jobs does
    not depend on theirs. Every dataset's view then reads its folder and its columns.
    """
    landed = land_lines(spark, layout.text_folder, lambda name, path: normalize_name(name, "bls_"), IGNORED_FILES)
    view = f"{layout.bronze}.text_files"
    published = publish(by_header(landed, CONTRACTS), layout.location(view), TEXT_RULES, view, "Raw rows of all files, all text.",
                        partition_by=["dataset"], log=layout.quality_log)
    for table in dataset_columns(landed.headers).toLocalIterator():
        columns = ", ".join(map(quoted, [*table.names, *[flag.predicate for flag in TEXT_RULES], *LINEAGE]))
        spark.sql(f"CREATE OR REPLACE VIEW {layout.bronze}.{table.dataset} COMMENT 'Raw rows of one dataset, all text.' AS "
                  f"SELECT {columns} FROM ({published.query}) WHERE dataset = '{table.dataset}'")
    report = expect_report(published.data, TEXT_RULES, by="dataset")
    outcomes: Outcomes = {}
    for row in report.toLocalIterator():
        outcomes.setdefault(row.dataset, []).append(RuleOutcome(row.rule, row["mode"], row.checked, row.violations))
    return outcomes


def population_bronze(spark: SparkSession, layout: Layout) -> list[RuleOutcome]:
    """Add the snapshots that arrived since the last run to the raw population table."""
    view = f"{layout.bronze}.population_raw"
    table = layout.location(view)
    files = snapshot_stream(spark, layout.population_folder, POPULATION_GLOB)
    parsed = parse_payload(identify(files, POPULATION_NAME), POPULATION_BODY, into="records")
    raw = flag_parsed(parsed, "records").select(
        "source_file",
        "fetched_at_utc",
        F.current_timestamp().alias("bronze_ingested_at_utc"),
        "raw_json",
        "records",
        F.col("path").alias("source_path"),
        F.col("modificationTime").alias("source_file_modified_at"),
        F.col("length").alias("source_file_size_bytes"),
        "payload_schema_valid",
        "population_data_not_empty",
        "fetched_on",
    )
    outcomes = ingest_available(raw, table, f"{table}_checkpoint", SNAPSHOT_RULES, partition_by=["fetched_on"],
                                log=layout.quality_log, dataset=view)
    newest = newest_ingested(spark, table)
    stored = stored_query(raw, table, no_files=newest is None)
    columns = ", ".join(map(quoted, raw.columns))
    spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT 'Every snapshot fetched.' TBLPROPERTIES ('{NEWEST}' = '{newest or ''}') "
              f"AS SELECT {columns} FROM ({stored})")
    return outcomes


def text_silver(spark: SparkSession, layout: Layout) -> Outcomes:
    """The typed tables; a missing required value or a repeated key stops the table."""
    def load(spec: ConformSpec) -> Callable[[], Published]:
        def task() -> Published:
            typed = conform_checked(spark.table(f"{layout.bronze}.{spec.source}"), spec)
            return _publish(layout, f"{layout.silver}.{spec.target}", typed, conform_rules(spec), spec.comment)
        return task

    return _side_by_side({spec.target: load(spec) for spec in SPECS})


def population_silver(spark: SparkSession, layout: Layout) -> Published:
    """The newest snapshot as one row per nation and year."""
    view = f"{layout.bronze}.population_raw"
    mark = spark.sql(f"SHOW TBLPROPERTIES {view} ('{NEWEST}')").first().value
    newest = latest_snapshot(spark.table(view), partition="fetched_on", newest_partition=mark)
    records = explode_parsed(newest.select("source_file", "fetched_at_utc", "records"), "records")
    typed = records.select(*record_fields(POPULATION_FIELDS), "source_file", "fetched_at_utc")
    checked = flag_unique_key(typed, ["nation_id", "year"])
    return _publish(layout, f"{layout.silver}.fct_population", checked, POPULATION_RULES, "Newest population snapshot.")


def series_lookups(spark: SparkSession, layout: Layout) -> list[Lookup]:
    def lookup(table: str, code: str, text: str) -> Lookup:
        return Lookup(spark.table(f"{layout.silver}.dim_bls_pr_{table}"), code, text, code)

    return [
        lookup("sector", "sector_code", "sector_name"),
        lookup("class", "class_code", "class_text"),
        lookup("measure", "measure_code", "measure_text"),
        lookup("duration", "duration_code", "duration_text"),
        lookup("seasonal", "seasonal_code", "seasonal_text"),
    ]


def gold(spark: SparkSession, layout: Layout) -> Outcomes:
    """The answers and the reusable tables they come from."""
    def name(table: str) -> str:
        return f"{layout.gold}.{table}"

    obs = spark.table(f"{layout.silver}.fct_bls_pr_data_1_alldata")
    done: Outcomes = {}

    def put(table: str, df: DataFrame, rules: Iterable[Expectation] = (), comment: str = "") -> DataFrame:
        published = _publish(layout, name(table), df, rules, comment)
        done[table] = published.outcomes
        return published.data

    population = put(
        "population_by_year",
        spark.table(f"{layout.silver}.fct_population").select("nation_id", "nation", "year", "population"),
        comment="Population of every year in the newest snapshot.",
    )
    put("population_summary_stats", range_stats(population, FIRST_YEAR, LAST_YEAR),
        comment=f"Mean and deviation of the population, {FIRST_YEAR} to {LAST_YEAR}.")

    yearly = gated_view(
        series_years(obs), scratch_path(spark, "series-years"), YEARLY_RULES, "bls_series_yearly_values_question_2",
        layout.quality_log,
    )
    done["bls_series_yearly_values_question_2"] = yearly.outcomes
    series = spark.table(f"{layout.silver}.dim_bls_pr_series")
    best = labelled_best_years(yearly.data, series, series_lookups(spark, layout))
    put("bls_series_best_year", best, LABEL_RULES, "Best year or tied best years of every series.")

    enriched = put("bls_series_period_population_by_year", observations_with_population(obs, population, expect_unique=True),
                   comment="Every observation with the population of its year.")
    put("bls_prs30006032_q01_population_by_year", one_series_and_period(enriched, TARGET_SERIES, TARGET_PERIOD),
        comment=f"{TARGET_SERIES} in {TARGET_PERIOD} with the population of the year.")
    return done


# Names of the published rules.
STRICT_RULES = (
    Expectation("recognized_period_codes_only", "_recognized_periods_only", FAIL),
    Expectation("complete_quarters_or_annual_only", "_complete_quarters_or_annual_only", WARN),
)


def gold_by_sql(spark: SparkSession, layout: Layout) -> Outcomes:
    """The answers by SQL, the best year by its strict rule, beside the main ones."""
    obs = spark.table(f"{layout.silver}.fct_bls_pr_data_1_alldata")
    population = spark.table(f"{layout.gold}.population_by_year")
    strict = gated_view(
        sql_twins.strict_years_sql(obs), scratch_path(spark, "series-years-sql"), STRICT_RULES,
        "bls_series_yearly_values_q2_sql", layout.quality_log,
    )
    labels = sql_twins.labels_sql(
        spark.table(f"{layout.silver}.dim_bls_pr_series"),
        *[item.table for item in series_lookups(spark, layout)],
    )
    best = sql_twins.labelled_best_years_sql(sql_twins.best_years_sql(strict.data), labels)
    tables = {
        "population_summary_sql_alternative": (sql_twins.range_stats_sql(population, FIRST_YEAR, LAST_YEAR), ()),
        "bls_series_best_year_sql_alternative": (best, LABEL_RULES),
        "bls_prs30006032_q01_population_by_year_sql_alternative": (
            sql_twins.series_period_sql(obs, one_per_key(population, "year"), TARGET_SERIES, TARGET_PERIOD), ()),
    }
    done = {
        table: _publish(layout, f"{layout.gold}.{table}", df, rules, "SQL version, for comparison.").outcomes
        for table, (df, rules) in tables.items()
    }
    return {"bls_series_yearly_values_q2_sql": strict.outcomes, **done}


def build(spark: SparkSession, layout: Layout) -> Outcomes:
    """Bring all layers up to date with what has landed."""
    for schema in (layout.bronze, layout.silver, layout.gold):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    outcomes = text_bronze(spark, layout)
    outcomes["population_raw"] = population_bronze(spark, layout)
    outcomes |= text_silver(spark, layout)
    outcomes["fct_population"] = population_silver(spark, layout).outcomes
    outcomes |= gold(spark, layout)
    return outcomes | gold_by_sql(spark, layout)
