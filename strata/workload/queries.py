"""The registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import base_name, folder_name
from strata.functions.text import normalize_name
from strata.operators import compare, conform, contracts, enrich, manifest, present, publish, quality, rollup, snapshots
from strata.plans import answers, productivity, sql_twins
from strata.session import scratch_path, written
from strata.sources import delimited, listing
from strata.streaming import snapshots as streams
from strata.workload import oracle_parts as part
from strata.workload import views
from strata.workload.registry import query, with_parts

# ---------------------------------------------------------------- rollup and best year

YEARLY_COLUMNS = (
    "series_id, year, quarter_count, _quarterly_sum, _q05_count, _q05_value, _unexpected_period_count, "
    "has_all_four_quarters, _recognized_periods_only, _has_usable_yearly_value, "
    "_all_four_quarters_or_annual_only, yearly_value, value_method"
)


@query("yearly_rollup", with_parts(f"SELECT {YEARLY_COLUMNS} FROM yearly", part.OBS, part.ROLLUP, part.YEARLY))
def yearly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.series_years(views.observations(spark, sf_dir))


@query(
    "yearly_rollup_check",
    with_parts(
        "SELECT series_id, year, "
        "CAST(sum(value) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS DECIMAL(28,3)) AS quarterly_sum, "
        "count(*) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS quarter_count, "
        "max(value) FILTER (WHERE period = 'Q05') AS q05_value FROM obs GROUP BY series_id, year",
        part.OBS,
    ),
)
def yearly_rollup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.yearly_rollup_check(views.observations(spark, sf_dir))


BEST_COLUMNS = (
    "b.series_id, l.sector_name, l.class_text, l.seasonal_text, l.measure_text, l.duration_text, b.value_method, "
    "b.best_year, b.yearly_value, l.human_readable_label, l._label_lookup_complete"
)


def _labelled_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = answers.series_years(views.observations(spark, sf_dir))
    return answers.labelled_best_years(yearly, views.series(spark, sf_dir), views.lookups(spark, sf_dir))


@query(
    "best_year",
    with_parts(
        f"SELECT {BEST_COLUMNS} FROM best b LEFT JOIN labelled l ON l.series_id = b.series_id",
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST, part.LABELS,
    ),
)
def best_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled_best(spark, sf_dir)


@query(
    "best_year_sql",
    with_parts(
        """
        SELECT b.series_id, b.best_year, b.yearly_value, b.value_method, l.sector_name, l.measure_text, l.class_text,
               l.duration_text, l.seasonal_text, l.human_readable_label, l._label_lookup_complete
        FROM strict_best b LEFT JOIN labelled l ON l.series_id = b.series_id
        """,
        part.OBS, part.ROLLUP, part.YEARLY, part.STRICT, part.LABELS,
    ),
)
def best_year_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = sql_twins.best_years_sql(sql_twins.strict_years_sql(views.observations(spark, sf_dir)))
    coded = [item.table.withColumnRenamed(item.code, item.points_from) for item in views.lookups(spark, sf_dir)]
    sector, classes, measure, duration, seasonal = coded
    labels = sql_twins.labels_sql(views.series(spark, sf_dir), sector, classes, measure, duration, seasonal)
    return sql_twins.labelled_best_years_sql(best, labels)


@query(
    "yearly_values_strict",
    with_parts(
        "SELECT series_id, year, yearly_value, value_method, _complete_quarters_or_annual_only FROM strict_yearly",
        part.OBS, part.ROLLUP, part.YEARLY, part.STRICT,
    ),
)
def yearly_values_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = answers.series_years(views.observations(spark, sf_dir), rollup.EXCLUDE)
    return yearly.select(
        "series_id", "year", "yearly_value", "value_method",
        F.col("_all_four_quarters_or_annual_only").alias("_complete_quarters_or_annual_only"),
    )


@query(
    "best_year_rank",
    with_parts(
        "SELECT series_id, best_year, yearly_value FROM best", part.OBS, part.ROLLUP, part.YEARLY, part.BEST
    ),
)
def best_year_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = answers.series_years(views.observations(spark, sf_dir))
    ranked = rollup.best_period_by_dense_rank(yearly)
    return ranked.select("series_id", F.col("year").alias("best_year"), "yearly_value")


# ---------------------------------------------------------------- contracts, typing, quality

CUSTOMER_CONTRACT = contracts.Contract.of("c_custkey c_name c_nationkey c_acctbal c_mktsegment", "c_custkey c_name")


@query(
    "contract_flags",
    """
    SELECT c_custkey, TRUE AS _expected_schema_valid,
           c_custkey % 13 <> 0 AND c_custkey % 7 <> 0 AS _non_null_key_valid
    FROM customer
    """,
)
def contract_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 13 == 0, F.lit(None)).when(key % 7 == 0, "   ").otherwise(F.col("c_name"))
    raw = views.table(spark, sf_dir, "customer").withColumn("c_name", name)
    return contracts.flag_contract(raw, CUSTOMER_CONTRACT).select(
        "c_custkey", contracts.SCHEMA_FLAG, contracts.KEY_FLAG
    )


CONFORM_ORACLES = {
    "lineitem": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id,
               CAST(l_quantity AS DECIMAL(18,3)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,3)) AS price,
               l_discount AS discount, l_returnflag AS return_flag, strftime(l_shipdate, '%Y-%m-%d') AS shipped_on,
               count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS _natural_key_unique
        FROM lineitem""",
    "customer": """
        SELECT c_custkey AS customer_id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation_code,
               CAST(c_acctbal AS DECIMAL(18,3)) AS balance, c_mktsegment AS segment, TRUE AS _natural_key_unique
        FROM customer""",
    "part": """
        SELECT p_partkey AS part_id, p_name AS part_text, p_brand AS brand, p_type AS type, p_size AS size,
               CAST(p_retailprice AS DECIMAL(18,3)) AS price, TRUE AS _natural_key_unique FROM part""",
    "supplier": """
        SELECT s_suppkey AS supplier_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation_code,
               s_acctbal AS balance, TRUE AS _natural_key_unique FROM supplier""",
    "nation": """
        SELECT CAST(n_nationkey AS VARCHAR) AS nation_code, n_name AS nation_text, n_regionkey AS region_code,
               TRUE AS _natural_key_unique FROM nation""",
    "region": """
        SELECT CAST(r_regionkey AS VARCHAR) AS region_code, r_name AS region_text, TRUE AS _natural_key_unique
        FROM region""",
}


def _register_conform(spec: conform.ConformSpec) -> None:
    @query(f"conform_{spec.source}", CONFORM_ORACLES[spec.source])
    def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = views.raw_table(spark, sf_dir, spec.source)
        return conform.conform_checked(raw, spec)


for _spec in views.SPECS:
    _register_conform(_spec)


def _typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform(views.raw_orders(spark, sf_dir), views.ORDERS_SPEC)


@query("conform_facts", with_parts("SELECT * FROM typed", part.TYPED_ORDERS))
def conform_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_orders(spark, sf_dir)


@query(
    "unique_key_flag",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS _natural_key_unique
    FROM lineitem
    """,
)
def unique_key_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return quality.flag_unique_key(lines, ["l_orderkey", "l_linenumber"])


ORDER_RULES = [
    quality.Expectation("order_id_not_null", "order_id IS NOT NULL", quality.WARN),
    quality.Expectation("total_not_null", "total IS NOT NULL", quality.WARN),
    quality.Expectation("priority_filled", "trim(priority) <> ''", quality.WARN),
    quality.Expectation("large_order", "total > 100000", quality.WARN),
    quality.Expectation("customer_known", "customer_id >= 0", quality.FAIL),
]


@query(
    "expect_report",
    with_parts(
        """
        SELECT 'order_id_not_null' AS rule, 'warn' AS mode, count(*) AS checked,
               CAST(sum(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM typed
        UNION ALL SELECT 'total_not_null', 'warn', count(*),
               CAST(sum(CASE WHEN total IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM typed
        UNION ALL SELECT 'priority_filled', 'warn', count(*),
               CAST(sum(CASE WHEN priority = '' THEN 1 ELSE 0 END) AS BIGINT) FROM typed
        UNION ALL SELECT 'large_order', 'warn', count(*),
               CAST(sum(CASE WHEN total > 100000 THEN 0 ELSE 1 END) AS BIGINT) FROM typed
        UNION ALL SELECT 'customer_known', 'fail', count(*),
               CAST(sum(CASE WHEN customer_id >= 0 THEN 0 ELSE 1 END) AS BIGINT) FROM typed
        """,
        part.TYPED_ORDERS,
    ),
)
def expect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_report(_typed_orders(spark, sf_dir), ORDER_RULES)


def _report_sql(source: str, *rules: tuple[str, str, str]) -> str:
    """Select that counts, per rule, the rows for which its SQL predicate is not true."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, '{mode}' AS mode, count(*) AS checked, "
        f"CAST(coalesce(sum(CASE WHEN {holds} THEN 0 ELSE 1 END), 0) AS BIGINT) AS violations FROM {source}"
        for name, mode, holds in rules
    )


@query(
    "expect_report_yearly",
    with_parts(
        _report_sql(
            "yearly",
            ("recognized_period_codes_only", "fail", "_unexpected_period_count = 0"),
            ("usable_yearly_value", "fail", "value_method IS NOT NULL"),
            ("all_four_quarters_when_quarterly", "warn", "quarter_count = 4 OR value_method = 'annual_average_q05'"),
        ),
        part.OBS, part.ROLLUP, part.YEARLY,
    ),
)
def expect_report_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_report(answers.series_years(views.observations(spark, sf_dir)), answers.YEARLY_RULES)


@query(
    "expect_report_labels",
    with_parts(
        _report_sql(
            "(SELECT l.* FROM best b LEFT JOIN labelled l ON l.series_id = b.series_id) t",
            ("human_readable_label_lookup_complete", "warn", "_label_lookup_complete"),
        ),
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST, part.LABELS,
    ),
)
def expect_report_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_report(_labelled_best(spark, sf_dir), answers.LABEL_RULES)


@query(
    "expect_report_snapshots",
    with_parts(
        _report_sql(
            "bodies",
            ("snapshot_known", "fail", "snapshot_id IS NOT NULL"),
            ("fetched_at_utc_not_null", "fail", "fetched_at_utc IS NOT NULL"),
            ("expected_population_schema", "warn", "kind IN ('whole', 'empty')"),
            ("population_data_not_empty", "warn", "kind = 'whole'"),
        ),
        part.BODIES,
    ),
)
def expect_report_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = snapshots.flag_payload(views.population_bodies(spark, sf_dir), views.POPULATION_BODY)
    rules = [
        quality.Expectation("snapshot_known", "snapshot_id IS NOT NULL", quality.FAIL),
        quality.Expectation("fetched_at_utc_not_null", "fetched_at_utc IS NOT NULL", quality.FAIL),
        quality.Expectation("expected_population_schema", "payload_schema_valid"),
        quality.Expectation("population_data_not_empty", "population_data_not_empty"),
    ]
    return quality.expect_report(flagged, rules)


@query(
    "expect_report_keys",
    """
    SELECT name AS rule, 'fail' AS mode, count(*) AS checked,
           CAST(sum(CASE name WHEN 'order_id_not_null' THEN CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END
                              WHEN 'line_not_null' THEN CASE WHEN l_linenumber IS NULL THEN 1 ELSE 0 END
                              ELSE CASE WHEN copies > 1 THEN 1 ELSE 0 END END) AS BIGINT) AS violations
    FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
          FROM lineitem) t,
         (VALUES ('order_id_not_null'), ('line_not_null'), ('unique_natural_key')) r(name)
    GROUP BY name
    """,
)
def expect_report_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rules a typed table gets from its specification, counted for line items."""
    spec = next(item for item in views.SPECS if item.source == "lineitem")
    typed = conform.conform_checked(views.raw_table(spark, sf_dir, spec.source), spec)
    return quality.expect_report(typed, conform.conform_rules(spec))


@query(
    "expect_rows",
    with_parts(
        """
        SELECT order_id, customer_id, ordered_on, priority, total,
               concat_ws(',', CASE WHEN order_id IS NULL THEN 'order_id_not_null' END,
                              CASE WHEN total IS NULL THEN 'total_not_null' END,
                              CASE WHEN priority = '' THEN 'priority_filled' END,
                              CASE WHEN total > 100000 THEN NULL ELSE 'large_order' END,
                              CASE WHEN customer_id >= 0 THEN NULL ELSE 'customer_known' END) AS _violated
        FROM typed
        WHERE order_id IS NULL OR total IS NULL OR priority = '' OR total <= 100000 OR customer_id IS NULL
        """,
        part.TYPED_ORDERS,
    ),
)
def expect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.expect_rows(_typed_orders(spark, sf_dir), ORDER_RULES)
    return bad.withColumn("_violated", F.concat_ws(",", "_violated"))


@query(
    "size_check",
    """
    SELECT doc_id, n_chars AS declared, octet_length(encode(text)) = n_chars AS size_matches FROM documents
    """,
)
def size_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    matches = manifest.size_matches(F.col("text"), F.col("n_chars"))
    return docs.select("doc_id", F.col("n_chars").alias("declared"), matches.alias("size_matches"))


@query("publish_gate", with_parts("SELECT * FROM typed", part.TYPED_ORDERS))
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.publish(
        _typed_orders(spark, sf_dir), scratch_path(spark, "fct_orders"), ORDER_RULES, "fct_orders_published",
        temporary=True,
    ).data


GATE_RULES = [
    quality.Expectation("order_id_not_null", "order_id IS NOT NULL", quality.FAIL),
    quality.Expectation("priority_filled", "trim(priority) <> ''", quality.WARN),
    quality.Expectation("customer_known", "customer_id >= 0", quality.FAIL),
]


@query(
    "publish_gate_outcomes",
    with_parts(
        "SELECT *, (SELECT count(*) FROM typed WHERE order_id IS NULL) = 0 AS published FROM ("
        + _report_sql(
            "typed", ("order_id_not_null", "fail", "order_id IS NOT NULL"), ("priority_filled", "warn", "priority <> ''"),
            ("customer_known", "fail", "customer_id >= 0"),
        ) + ") r",
        part.TYPED_ORDERS,
    ),
)
def publish_gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a gate that a failing rule closes has counted, and that readers got nothing."""
    try:
        outcomes = publish.publish(_typed_orders(spark, sf_dir), scratch_path(spark, "gated-orders"), GATE_RULES).outcomes
        published = True
    except quality.GateError as stopped:
        outcomes, published = stopped.outcomes, False
    rows = [(o.name, o.mode, o.checked, o.violations, published) for o in outcomes]
    return spark.createDataFrame(rows, "rule string, mode string, checked bigint, violations bigint, published boolean")


@query(
    "gated_view_by_name",
    with_parts("SELECT series_id, year, yearly_value, value_method FROM yearly", part.OBS, part.ROLLUP, part.YEARLY),
)
def gated_view_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checked intermediate that the next step reads by its name."""
    yearly = answers.series_years(views.observations(spark, sf_dir))
    rules = [quality.Expectation("year_known", "year IS NOT NULL", quality.FAIL)]
    publish.gated_view(yearly, scratch_path(spark, "gated-years"), rules, "strata_gated_years")
    return spark.table("strata_gated_years").select("series_id", "year", "yearly_value", "value_method")


@query(
    "expect_report_contract",
    _report_sql(
        "customer", ("expected_schema", "warn", "TRUE"), ("non_null_key", "warn", "c_custkey % 13 <> 0 AND c_custkey % 7 <> 0"),
    ),
)
def expect_report_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warnings of raw text tables: their layout, and keys that are missing or blank."""
    return quality.expect_report(contract_flags(spark, sf_dir), productivity.TEXT_RULES)


@query(
    "expect_report_population",
    with_parts(
        _report_sql(
            "(SELECT *, count(*) OVER (PARTITION BY nation_id, year) AS copies FROM ("
            "SELECT * FROM records UNION ALL SELECT snapshot_id, fetched_at_utc, NULL, NULL, NULL, NULL "
            "FROM bodies WHERE kind <> 'whole') r WHERE fetched_at_utc = (SELECT max(o_orderdate) FROM orders)) t",
            ("nation_id_not_null", "fail", "nation_id IS NOT NULL"), ("year_not_null", "fail", "year IS NOT NULL"),
            ("population_not_null", "fail", "population IS NOT NULL"), ("unique_nation_year", "fail", "copies = 1"),
        ),
        part.BODIES,
    ),
)
def expect_report_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rules of the typed population, counted for the newest snapshot."""
    return quality.expect_report(typed_snapshot(spark, sf_dir), productivity.POPULATION_RULES)


@query(
    "expect_report_strict",
    with_parts(
        _report_sql(
            "strict_yearly", ("recognized_period_codes_only", "fail", "_recognized_periods_only"),
            ("complete_quarters_or_annual_only", "warn", "value_method IS NOT NULL"),
        ),
        part.OBS, part.ROLLUP, part.YEARLY, part.STRICT,
    ),
)
def expect_report_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the strict years as the SQL version computes them."""
    strict = sql_twins.strict_years_sql(views.observations(spark, sf_dir))
    return quality.expect_report(strict, productivity.STRICT_RULES)


# ---------------------------------------------------------------- enrichment and statistics


@query(
    "label_lookup",
    with_parts(
        "SELECT series_id, sector_name, class_text, measure_text, duration_text, seasonal_text, "
        "_label_lookup_complete, human_readable_label FROM labelled",
        part.LABELS,
    ),
)
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.label_lookup(
        views.series(spark, sf_dir), "series_id", views.lookups(spark, sf_dir), answers.LABEL_ORDER
    )


@query(
    "enrich_by_year",
    with_parts(
        "SELECT o.series_id, o.period, o.year, o.value, p.population "
        "FROM obs o LEFT JOIN population p ON o.year = p.year",
        part.OBS, part.POPULATION,
    ),
)
def enrich_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.observations_with_population(
        views.observations(spark, sf_dir), views.yearly_population(spark, sf_dir), expect_unique=True
    )


SERIES, PERIOD = "S5", "Q05"


@query(
    "series_period_by_year",
    with_parts(
        "SELECT o.series_id, o.period, o.year, o.value, p.population "
        f"FROM obs o LEFT JOIN population p ON o.year = p.year WHERE series_id = '{SERIES}' AND period = '{PERIOD}'",
        part.OBS, part.POPULATION,
    ),
)
def series_period_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.one_series_and_period(enrich_by_year(spark, sf_dir), SERIES, PERIOD)


@query(
    "series_period_sql",
    with_parts(
        "SELECT o.series_id, o.period, o.year, o.value, p.population "
        f"FROM obs o LEFT JOIN population p ON o.year = p.year WHERE series_id = '{SERIES}' AND period = '{PERIOD}'",
        part.OBS, part.POPULATION,
    ),
)
def series_period_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    population = enrich.one_per_key(views.yearly_population(spark, sf_dir), "year")
    return sql_twins.series_period_sql(views.observations(spark, sf_dir), population, SERIES, PERIOD)


@query(
    "series_period_diff",
    with_parts(
        f"""
        , one AS (
            SELECT o.series_id, o.period, o.year, o.value, CAST(round(p.population) AS BIGINT) AS population
            FROM obs o LEFT JOIN population p ON o.year = p.year WHERE series_id = '{SERIES}' AND period = '{PERIOD}'),
        late AS (SELECT series_id, period, year, value, CASE WHEN year < 2000 THEN population END AS population FROM one)
        SELECT 'pyspark_only' AS mismatch_type, * FROM (SELECT * FROM one EXCEPT SELECT * FROM late) a
        UNION ALL SELECT 'sql_only', * FROM (SELECT * FROM late EXCEPT SELECT * FROM one) b
        """,
        part.OBS, part.POPULATION,
    ),
)
def series_period_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of the answer compared row by row; the SQL one was given a lookup that ends in 1999."""
    obs = written(views.observations(spark, sf_dir), "observations")
    people = views.yearly_population(spark, sf_dir).select("year", F.round("population").cast("bigint").alias("population"))
    people = written(people, "population")
    frame = answers.one_series_and_period(answers.observations_with_population(obs, people, True), SERIES, PERIOD)
    by_sql = sql_twins.series_period_sql(obs, people.where("year < 2000"), SERIES, PERIOD)
    return compare.two_way_diff(frame, by_sql, "pyspark_only", "sql_only")


def _priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("nation_id"),
        F.col("o_orderstatus").alias("nation"),
        F.col("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("population"),
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Four places: sums of doubles depend on the order of addition beyond that."""
    return df.withColumns({c: F.round(c, 4) for c in ("mean_population", "stddev_population")})


@query(
    "range_stats",
    """
    SELECT max(o_orderpriority) AS nation_id, max(o_orderstatus) AS nation, 1996 AS start_year, 1998 AS end_year,
           round(avg(o_totalprice), 4) AS mean_population, round(stddev_samp(o_totalprice), 4) AS stddev_population
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
    """,
)
def range_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollup.range_stats(_priorities(spark, sf_dir), 1996, 1998, day="day"))


RANGE_GROUPED = """
    SELECT o_orderpriority AS nation_id, o_orderstatus AS nation, 1996 AS start_year, 1998 AS end_year,
           round(avg(o_totalprice), 4) AS mean_population, round(stddev_samp(o_totalprice), 4) AS stddev_population,
           count(*) AS year_count
    FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998)
    GROUP BY o_orderpriority, o_orderstatus
"""


@query("range_stats_grouped", RANGE_GROUPED)
def range_stats_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollup.range_stats_grouped(_priorities(spark, sf_dir), 1996, 1998, day="day"))


@query("range_stats_sql", RANGE_GROUPED)
def range_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sql_twins.range_stats_sql(_priorities(spark, sf_dir), 1996, 1998, day="day"))


# ---------------------------------------------------------------- snapshots


@query(
    "latest_snapshot",
    """
    SELECT event_id, user_id, event_type, value, props, ts AS fetched_at_utc FROM events
    WHERE date_trunc('day', ts) = (SELECT date_trunc('day', max(ts)) FROM events)
    """,
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the last day; the comparison is on the stored time, so older row groups are skipped."""
    events = views.table(spark, sf_dir, "events").withColumnRenamed("ts", "fetched_at_utc")
    return snapshots.latest_snapshot(events, unit="day")


@query("top1_snapshot", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def top1_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.newest_row(views.table(spark, sf_dir, "events"), "ts", "event_id")


RECORD = {"Nation ID": "nation_id", "Nation": "nation", "Year": "year", "Population": "population"}


@query(
    "json_explode",
    with_parts(
        "SELECT * FROM records UNION ALL "
        "SELECT snapshot_id, fetched_at_utc, NULL, NULL, NULL, NULL FROM bodies WHERE kind <> 'whole'",
        part.BODIES,
    ),
)
def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = snapshots.explode_records(views.population_bodies(spark, sf_dir), views.POPULATION_BODY)
    return exploded.select("snapshot_id", "fetched_at_utc", *snapshots.record_fields(RECORD))


RECORD_TYPE = "struct<`Nation ID`: string, Nation: string, Year: bigint, Population: double>"


@query(
    "json_explode_inner",
    with_parts(
        "SELECT snapshot_id, CAST(year AS INTEGER) AS year, CAST(trunc(population) AS BIGINT) AS population "
        "FROM records",
        part.BODIES,
    ),
)
def json_explode_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = snapshots.explode_list(views.population_bodies(spark, sf_dir), RECORD_TYPE)
    return exploded.select(
        "snapshot_id",
        F.col("_record.Year").cast("int").alias("year"),
        F.col("_record.Population").cast("bigint").alias("population"),
    )


@query(
    "payload_flags",
    with_parts(
        "SELECT snapshot_id, kind IN ('whole', 'empty') AS payload_schema_valid, "
        "CASE kind WHEN 'whole' THEN TRUE WHEN 'empty' THEN FALSE END AS population_data_not_empty, "
        "kind <> 'broken' AS is_json FROM bodies",
        part.BODIES,
    ),
)
def payload_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = snapshots.parse_payload(views.population_bodies(spark, sf_dir), views.POPULATION_BODY)
    return snapshots.flag_parsed(parsed).select(
        "snapshot_id", "payload_schema_valid", "population_data_not_empty",
        snapshots.is_json(F.col("raw_json")).alias("is_json"),
    )


@query(
    "typed_snapshot",
    with_parts(
        """
        SELECT nation_id, nation, year, population, fetched_at_utc,
               count(*) OVER (PARTITION BY nation_id, year) = 1 AS _natural_key_unique
        FROM (SELECT * FROM records UNION ALL
              SELECT snapshot_id, fetched_at_utc, NULL, NULL, NULL, NULL FROM bodies WHERE kind <> 'whole') r
        WHERE fetched_at_utc = (SELECT max(o_orderdate) FROM orders)
        """,
        part.BODIES,
    ),
)
def typed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = snapshots.latest_snapshot(views.population_bodies(spark, sf_dir))
    typed = snapshots.explode_records(newest, views.POPULATION_BODY).select(
        *snapshots.record_fields(RECORD), "fetched_at_utc"
    )
    return quality.flag_unique_key(typed, ["nation_id", "year"])


EVENT_SNAPSHOT = views.EVENT_SNAPSHOT


@query(
    "snapshot_name_time",
    """
    SELECT event_id, 'events__fetched_' || strftime(ts, '%Y-%m-%d__%H_%M_%S') || '_UTC.json' AS source_file,
           strftime(ts, '%Y-%m-%d__%H_%M_%S') AS fetched_at_text,
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS fetched_at_seconds
    FROM events
    """,
)
def snapshot_name_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/landing/events/"), EVENT_SNAPSHOT.name_for(F.col("ts")))
    named = views.table(spark, sf_dir, "events").select("event_id", base_name(path).alias("source_file"))
    name = F.col("source_file")
    return named.select(
        "event_id", "source_file",
        EVENT_SNAPSHOT.fetched_text(name).alias("fetched_at_text"),
        F.unix_seconds(EVENT_SNAPSHOT.fetched_at(name)).alias("fetched_at_seconds"),
    )


STREAM_RULES = quality.expect_all(
    {"source_file_not_null": "source_file IS NOT NULL", "fetched_at_utc_not_null": "fetched_at_utc IS NOT NULL",
     "raw_json_not_null": "raw_json IS NOT NULL"},
    quality.FAIL,
)


@query(
    "stream_snapshots",
    """
    SELECT event_id, 'events__fetched_' || strftime(ts, '%Y-%m-%d') || '__00_00_00_UTC.json' AS source_file,
           CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS fetched_at_seconds, value,
           CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) AS k
    FROM events
    """,
)
def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in daily snapshots, first up to mid-month and then the rest; each landing is
    followed by an incremental run on the same checkpoint. Files are cut at a fixed number of
    records, so a day with many events becomes many files and not one long one.
    """
    landing, raw, checkpoint = (scratch_path(spark, name) for name in ("landing", "raw", "checkpoint"))
    events = views.table(spark, sf_dir, "events")
    name = EVENT_SNAPSHOT.name_for(F.date_trunc("day", "ts"))
    lines = events.select("ts", name.alias("snapshot"), F.to_json(F.struct("event_id", "value", "props")).alias("line"))
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    for arrived in (F.col("ts") < half, F.col("ts") >= half):
        new = lines.where(arrived).select("snapshot", "line")
        new.write.mode("append").partitionBy("snapshot").option("maxRecordsPerFile", 10000).text(landing)
        files = streams.snapshot_stream(spark, landing, "*.txt", recursive=True)
        found = streams.identify(files, EVENT_SNAPSHOT, folder_name(F.col("path"))).select(
            "source_file", "fetched_at_utc", "fetched_on", "raw_json"
        )
        streams.ingest_available(found, raw, checkpoint, STREAM_RULES, partition_by=["fetched_on"])
    line = F.explode(F.split("raw_json", "\n"))
    stored = spark.read.parquet(raw).select("source_file", "fetched_at_utc", line.alias("line")).where("line <> ''")
    event = F.from_json("line", "event_id bigint, value double, props string")
    return stored.withColumn("e", event).select(
        "e.event_id",
        "source_file",
        F.unix_seconds("fetched_at_utc").alias("fetched_at_seconds"),
        "e.value",
        F.from_json("e.props", "k bigint").getField("k").alias("k"),
    )


@query(
    "snapshot_append",
    """
    SELECT 'fetched-1' AS snapshot, o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 'fetched-2', o_orderkey, o_totalprice * 2 FROM orders
    UNION ALL SELECT 'fetched-3', o_orderkey, o_totalprice * 3 FROM orders
    """,
)
def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    location = scratch_path(spark, "fetches")
    fetches = {
        "fetched-1": orders,
        "fetched-2": orders.withColumn("o_totalprice", F.col("o_totalprice") * 2),
        "fetched-3": orders.withColumn("o_totalprice", F.col("o_totalprice") * 3),
    }
    paths = [publish.append_snapshot(df, location, name) for name, df in fetches.items()]
    landed = spark.read.parquet(*paths)
    return landed.select(folder_name(F.col("_metadata.file_path")).alias("snapshot"), "o_orderkey", "o_totalprice")


# ---------------------------------------------------------------- manifests, listings, files

RUN_TIME = "2002-01-01 00:00:00"


def _run_time() -> Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.reconcile(*views.order_files(spark, sf_dir), _run_time())


@query(
    "snapshot_diff",
    with_parts(
        f"""
        SELECT file_name, action, coalesce(new_modified, old_modified) AS source_last_modified,
               coalesce(new_size, old_size) AS source_size_bytes,
               coalesce(first_seen_at, TIMESTAMP '{RUN_TIME}') AS first_seen_at,
               CASE WHEN listed THEN TIMESTAMP '{RUN_TIME}' ELSE last_seen_at END AS last_seen_at,
               CASE WHEN action IN ('new', 'changed') THEN TIMESTAMP '{RUN_TIME}' ELSE last_downloaded_at END
                   AS last_downloaded_at,
               CASE action WHEN 'removed' THEN TIMESTAMP '{RUN_TIME}' WHEN 'absent' THEN removed_at END AS removed_at,
               CASE WHEN listed THEN 'active' ELSE 'removed' END AS status
        FROM compared
        """,
        part.FILES,
    ),
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)


@query(
    "diff_summary",
    with_parts(
        "SELECT count(*) FILTER (WHERE action = 'new') AS new, count(*) FILTER (WHERE action = 'changed') AS changed, "
        "count(*) FILTER (WHERE action = 'unchanged') AS unchanged, "
        "count(*) FILTER (WHERE action = 'removed') AS removed, "
        "count(*) FILTER (WHERE action IN ('new', 'changed')) AS downloads FROM compared",
        part.FILES,
    ),
)
def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.change_summary(_reconciled(spark, sf_dir))


@query(
    "change_events",
    with_parts(
        f"SELECT TIMESTAMP '{RUN_TIME}' AS observed_at, action AS event_type, file_name "
        "FROM compared WHERE action IN ('new', 'changed', 'removed')",
        part.FILES,
    ),
)
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "change-log")
    publish.append_rows(manifest.change_events(_reconciled(spark, sf_dir), _run_time()), log)
    return spark.read.parquet(log)


@query("content_hash", "SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", manifest.content_hash(F.col("text")).alias("content_sha256"))


@query(
    "content_changes",
    "SELECT doc_id, sha256(text) AS content_sha256 FROM documents WHERE lang <> 'en' OR source = 'src1'",
)
def content_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored before: every source but one, and all but the English texts in an older version."""
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    older = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.concat("text", F.lit(".")))
    stored = docs.where("source <> 'src1'").select("doc_id", manifest.content_hash(older).alias("content_sha256"))
    changed = manifest.content_changes(docs, stored, "doc_id", "text")
    return changed.select("doc_id", "content_sha256")


@query(
    "extract_links",
    """
    WITH found AS (
        SELECT page_id, url,
               regexp_extract_all(html, '(?i)<a\\s+href="([^"]+)">([^<]+)</a>', 1) AS hrefs,
               regexp_extract_all(html, '(?i)<a\\s+href="([^"]+)">([^<]+)</a>', 2) AS names
        FROM pages
    ), links AS (
        SELECT page_id, url, unnest(hrefs) AS href, trim(unnest(names)) AS file_name,
               generate_subscripts(hrefs, 1) AS place
        FROM found
    )
    SELECT page_id, file_name,
           CASE WHEN href LIKE '%://%' THEN href ELSE regexp_extract(url, '^[a-z]+://[^/]*') || href END AS source_url
    FROM (SELECT *, row_number() OVER (PARTITION BY page_id, file_name ORDER BY place DESC) AS n FROM links) t
    WHERE n = 1
    """,
)
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.page_links(views.table(spark, sf_dir, "pages"))


@query(
    "listing_rows",
    """
    SELECT p_partkey AS page_id, 'p' || p_partkey || suffix AS file_name,
           'https://files.example.org/pub/' || folder || 'p' || p_partkey || suffix AS source_url,
           CASE WHEN suffix = '.data' THEN '12/31/2024 11:59 PM'
                ELSE '1/' || (p_partkey % 28 + 1) || '/2024  9:05 AM' END AS source_last_modified,
           CAST(p_size + more AS BIGINT) AS source_size_bytes
    FROM part, (VALUES ('.series', 'time/', 1), ('.txt', '', 2), ('.data', 'new/', 3)) f(suffix, folder, more)
    """,
)
def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.listing_rows(views.listing_pages(spark, sf_dir), "https://files.example.org/pub/time/")


@query(
    "normalize_name",
    """
    SELECT page_id, 'bls_' || trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS table_name FROM pages
    """,
)
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", normalize_name(F.col("url"), "bls_").alias("table_name"))


@query(
    "discover_files",
    """
    SELECT DISTINCT event_type AS dataset, 'raw_' || event_type AS table_name, TRUE AS has_content
    FROM events WHERE event_type <> 'error'
    """,
)
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing folder per event type, found again by listing the files; those of one type are ignored by name."""
    landing = scratch_path(spark, "landing")
    lines = views.table(spark, sf_dir, "events").select("event_type", F.to_json(F.struct("*")).alias("line"))
    for part_of_run in ("event_type <> 'error'", "event_type = 'error'"):
        lines.where(part_of_run).write.mode("append").partitionBy("event_type").text(landing)
    found = listing.discover_files(spark, landing, recursive=True).withColumn("dataset", folder_name(F.col("path")))
    ignored = found.where("dataset = 'error'").select("file_name")  # as many as there were writers, so joined and not listed
    by_folder = found.join(ignored, "file_name", "left_anti").groupBy("dataset")
    sizes = by_folder.agg((F.sum("size_bytes") > 0).alias("has_content"))
    return sizes.withColumn("table_name", normalize_name(F.col("dataset"), "raw_"))


@query(
    "scan_delimited",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
           CAST(CAST(o_totalprice AS DECIMAL(18,3)) AS VARCHAR) AS o_totalprice
    FROM orders
    """,
)
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders.txt")
    names = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    raw = views.raw_table(spark, sf_dir, "orders").select(*[F.col(n).alias(f" {n.upper()}  ") for n in names])
    delimited.write_delimited(raw, path)
    return delimited.scan_delimited(spark, path)


@query(
    "scan_lineage",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority AS source_folder, TRUE AS is_text_file,
           TRUE AS name_ends_path FROM orders
    """,
)
def scan_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a folder of text files with the file each comes from; the reading time is left out."""
    path = scratch_path(spark, "orders-by-priority")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    delimited.write_delimited(orders, path, partition_by=["o_orderpriority"])
    traced = delimited.add_lineage(delimited.scan_delimited(spark, path))
    return traced.select(
        "o_orderkey", F.url_decode(folder_name(F.col("_source_path"))).alias("source_folder"),
        F.col("_source_file").endswith(".csv").alias("is_text_file"),
        F.col("_source_path").endswith(F.col("_source_file")).alias("name_ends_path"),
    )


@query(
    "stream_expect_report",
    """
    SELECT rule, CAST(sum(checked) AS BIGINT) AS checked, CAST(sum(violations) AS BIGINT) AS violations FROM (
        SELECT 'raw_json_not_null' AS rule, count(DISTINCT date_trunc('day', ts)) AS checked, 0 AS violations FROM events
        UNION ALL
        SELECT 'many_events', count(*), sum(CASE WHEN n >= 100 THEN 0 ELSE 1 END)
        FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) d
    ) r GROUP BY rule
    """,
)
def stream_expect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of two incremental runs, every file a micro-batch of its own."""
    landing, raw, checkpoint = (scratch_path(spark, name) for name in ("landing", "raw", "checkpoint"))
    events = views.table(spark, sf_dir, "events")
    name = EVENT_SNAPSHOT.name_for(F.date_trunc("day", "ts"))
    bodies = events.groupBy(name.alias("snapshot")).agg(F.count("*").cast("string").alias("line"))
    rules = [
        quality.Expectation("raw_json_not_null", "raw_json IS NOT NULL", quality.FAIL),
        quality.Expectation("many_events", "CAST(trim(raw_json) AS INT) >= 100"),
    ]
    totals: dict[str, list[int]] = {rule.name: [0, 0] for rule in rules}
    half = EVENT_SNAPSHOT.name_for(F.lit("2024-01-16").cast("timestamp_ntz"))
    for arrived in (F.col("snapshot") < half, F.col("snapshot") >= half):
        bodies.where(arrived).repartition("snapshot").write.mode("append").partitionBy("snapshot").text(landing)
        files = streams.snapshot_stream(spark, landing, "*.txt", recursive=True, max_files=1)
        found = streams.identify(files, EVENT_SNAPSHOT, folder_name(F.col("path"))).select("source_file", "raw_json")
        for outcome in streams.ingest_available(found, raw, checkpoint, rules):
            totals[outcome.name][0] += outcome.checked
            totals[outcome.name][1] += outcome.violations
    rows = [(rule, *counts) for rule, counts in totals.items()]
    return spark.createDataFrame(rows, "rule string, checked bigint, violations bigint")


# ---------------------------------------------------------------- comparison and presentation


def _both_bests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rolled = rollup.yearly_rollup(views.observations(spark, sf_dir))
    chosen = []
    for incomplete in (rollup.KEEP, rollup.EXCLUDE):
        best = rollup.best_period(rollup.yearly_values(rolled, incomplete))
        chosen.append(best.select("series_id", F.col("year").alias("best_year"), "yearly_value"))
    return chosen[0], chosen[1]


SIDES = """
lenient AS (SELECT series_id, best_year, yearly_value FROM best),
strict AS (SELECT series_id, best_year, yearly_value FROM strict_best),
missing AS (SELECT * FROM lenient EXCEPT SELECT * FROM strict),
unexpected AS (SELECT * FROM strict EXCEPT SELECT * FROM lenient)
"""


@query(
    "two_way_diff",
    with_parts(
        "SELECT 'missing_from_gold' AS mismatch_type, * FROM missing "
        "UNION ALL SELECT 'unexpected_in_gold', * FROM unexpected",
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST, part.STRICT, SIDES,
    ),
)
def two_way_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lenient, strict = _both_bests(spark, sf_dir)
    return compare.two_way_diff(lenient, strict, "missing_from_gold", "unexpected_in_gold")


@query(
    "diff_counts",
    with_parts(
        "SELECT 'pyspark_minus_sql' AS comparison, count(*) AS differences FROM missing "
        "UNION ALL SELECT 'sql_minus_pyspark', count(*) FROM unexpected",
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST, part.STRICT, SIDES,
    ),
)
def diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.diff_counts(*_both_bests(spark, sf_dir), "pyspark_minus_sql", "sql_minus_pyspark")


@query(
    "twin_diff_counts",
    with_parts(
        """
        , ranked AS (
            SELECT series_id, year AS best_year, yearly_value,
                   dense_rank() OVER (PARTITION BY series_id ORDER BY yearly_value DESC NULLS LAST) AS place
            FROM strict_yearly
        ), other AS (
            SELECT series_id, best_year, yearly_value FROM ranked WHERE place = 1 AND yearly_value IS NOT NULL
        ), this AS (SELECT series_id, best_year, yearly_value FROM strict_best)
        SELECT 'pyspark_minus_sql' AS comparison, count(*) AS differences
        FROM (SELECT * FROM this EXCEPT SELECT * FROM other) a
        UNION ALL
        SELECT 'sql_minus_pyspark', count(*) FROM (SELECT * FROM other EXCEPT SELECT * FROM this) b
        """,
        part.OBS, part.ROLLUP, part.YEARLY, part.STRICT,
    ),
)
def twin_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict answer by DataFrame operators against the same answer in SQL: no difference."""
    columns = ("series_id", "best_year", "yearly_value")
    obs = written(views.observations(spark, sf_dir), "observations")
    by_frame = answers.best_years(answers.series_years(obs, rollup.EXCLUDE)).select(*columns)
    by_sql = sql_twins.best_years_sql(sql_twins.strict_years_sql(obs)).select(*columns)
    return compare.diff_counts(by_frame, by_sql, "pyspark_minus_sql", "sql_minus_pyspark")


#: A fault put into one layer by a rule on the key, so that the traces have gaps to find.
FAULTY = "CAST(substr(series_id, 2) AS BIGINT) % 19 = 0 AND year % 2 = 0"


@query(
    "layer_trace",
    with_parts(
        f"""
        , cases AS (
            SELECT DISTINCT series_id, year,
                   CASE WHEN has_all_four_quarters THEN 'normal_quarterly'
                        WHEN quarter_count > 0 THEN 'incomplete_year' ELSE 'q05_only' END AS test_case
            FROM yearly
        ), layers AS (
            SELECT 'bronze' AS layer, series_id, year, period, value FROM obs
            UNION ALL
            SELECT 'silver', series_id, year, period, value + CASE WHEN {FAULTY} THEN 0.25 ELSE 0 END FROM obs
        ), counted AS (
            SELECT layer, series_id, year, count(*) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS n,
                   sum(value) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS s,
                   max(value) FILTER (WHERE period = 'Q05') AS a
            FROM layers GROUP BY layer, series_id, year
        ), valued AS (
            SELECT *, CAST(CASE WHEN n = 4 THEN s WHEN n = 0 THEN a END AS DECIMAL(28,3)) AS v FROM counted
        )
        SELECT c.test_case, v.series_id, v.year, v.n AS bronze_quarter_count,
               round(CAST(v.v AS DOUBLE), 3) AS bronze_yearly_value, w.n AS silver_quarter_count,
               w.v AS silver_yearly_value, b.yearly_value AS gold_yearly_value,
               round(CAST(abs(v.v - w.v) AS DOUBLE), 3) AS bronze_vs_silver_diff,
               round(CAST(abs(w.v - b.yearly_value) AS DOUBLE), 3) AS silver_vs_gold_diff,
               round(CAST(abs(v.v - b.yearly_value) AS DOUBLE), 3) AS bronze_vs_gold_diff
        FROM valued v JOIN cases c ON c.series_id = v.series_id AND c.year = v.year
        JOIN valued w ON w.layer = 'silver' AND w.series_id = v.series_id AND w.year = v.year
        LEFT JOIN best b ON b.series_id = v.series_id AND b.best_year = v.year
        WHERE v.layer = 'bronze'
        """,
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST,
    ),
)
def layer_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series and year is a case, named by the kind of year it is; the typed layer holds faults."""
    obs = written(views.observations(spark, sf_dir), "observations")
    yearly = answers.series_years(obs)
    kind = (
        F.when(F.col("has_all_four_quarters"), "normal_quarterly")
        .when(F.col("quarter_count") > 0, "incomplete_year")
        .otherwise("q05_only")
    )
    cases = yearly.select("series_id", "year", kind.alias("test_case"))
    shift = F.when(F.expr(FAULTY), F.expr("0.25BD")).otherwise(F.expr("0BD"))
    silver = obs.withColumn("value", (F.col("value") + shift).cast("decimal(18,3)"))
    traced = compare.layer_trace(cases, views.raw_observations(obs), silver, answers.best_years(yearly))
    return traced.withColumns(
        {
            "bronze_yearly_value": F.round("bronze_yearly_value", 3),
            "silver_yearly_value": F.col("silver_yearly_value").cast("decimal(28,3)"),
            "silver_vs_gold_diff": F.col("silver_vs_gold_diff").cast("double"),
        }
    )


CASES = (
    "('normal_quarterly', 'S7', 1996), ('normal_quarterly', 'S8', 1998), ('incomplete_year', 'S21', 1995), "
    "('incomplete_year', 'S21', 1997), ('q05_only', 'S5', 1996), ('q05_only', 'S10', 1999), "
    "('tied_best_years', 'S22', 1996), ('tied_best_years', 'S22', 1998)"
)


@query(
    "trace_cases",
    with_parts(
        f"""
        , cases(test_case, series_id, year) AS (VALUES {CASES})
        SELECT c.test_case, o.series_id, o.year,
               round(CAST(sum(value) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS DOUBLE), 3)
                   AS quarterly_sum,
               count(*) FILTER (WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04')) AS quarter_count,
               CAST(max(value) FILTER (WHERE period = 'Q05') AS DOUBLE) AS q05_value
        FROM obs o JOIN cases c ON o.series_id = c.series_id AND o.year = c.year
        GROUP BY c.test_case, o.series_id, o.year
        """,
        part.OBS,
    ),
)
def trace_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup of chosen cases from the text layer, values converted to double on the way."""
    cases = spark.sql(f"SELECT * FROM VALUES {CASES} AS t(test_case, series_id, year)")
    raw = views.raw_observations(views.observations(spark, sf_dir)).select(
        F.trim("series_id").alias("series_id"),
        F.trim("year").try_cast("int").alias("year"),
        F.trim("period").alias("period"),
        F.trim("value").try_cast("double").alias("value"),
    )
    traced = compare.case_rollup(cases, raw)
    return traced.withColumn("quarterly_sum", F.round("quarterly_sum", 3)).orderBy("test_case", "series_id", "year")


YEAR_CASES = (
    "(1, 'value and population', 1997), (2, 'value, no population', 1995), (3, 'population only', 2002), "
    "(4, 'stale answer', 1996), (5, 'value and population', 1999), (6, 'neither', 1900)"
)
#: Years whose published answer is out of date, so that the trace has gaps to find.
STALE = "year % 2 = 0"


@query(
    "enrichment_trace",
    with_parts(
        f"""
        , cases(test_case, test_name, year) AS (VALUES {YEAR_CASES}),
        silver AS (SELECT * FROM obs WHERE series_id = '{SERIES}' AND period = '{PERIOD}'),
        bodies_of_years AS (SELECT year, CAST(round(population) AS BIGINT) AS people FROM population),
        generic AS (SELECT s.year, s.value, b.people FROM silver s LEFT JOIN bodies_of_years b ON b.year = s.year),
        specific AS (
            SELECT year, CAST(value + CASE WHEN {STALE} THEN 0.125 ELSE 0 END AS DECIMAL(18,3)) AS value,
                   people + CASE WHEN {STALE} THEN 7 ELSE 0 END AS people FROM generic)
        SELECT c.test_case, c.test_name, c.year, CAST(s.value AS DOUBLE) AS bronze_bls_value, s.value AS silver_bls_value,
               g.value AS generic_table_gold_value, p.value AS specific_table_gold_value,
               b.people AS bronze_population, g.people AS generic_gold_population,
               CAST(p.people AS BIGINT) AS specific_gold_population,
               abs(CAST(s.value AS DOUBLE) - CAST(s.value AS DOUBLE)) AS bronze_vs_silver_value_diff,
               CAST(abs(s.value - g.value) AS DOUBLE) AS silver_vs_generic_table_gold_value_diff,
               CAST(abs(g.value - p.value) AS DOUBLE) AS generic_vs_specific_table_gold_value_diff,
               CASE WHEN b.people IS NULL AND g.people IS NULL THEN 0 ELSE CAST(abs(b.people - g.people) AS DOUBLE) END
                   AS bronze_vs_generic_gold_population_diff,
               CASE WHEN g.people IS NULL AND p.people IS NULL THEN 0 ELSE CAST(abs(g.people - p.people) AS DOUBLE) END
                   AS generic_vs_specific_gold_population_diff
        FROM cases c LEFT JOIN silver s ON s.year = c.year LEFT JOIN bodies_of_years b ON b.year = c.year
        LEFT JOIN generic g ON g.year = c.year LEFT JOIN specific p ON p.year = c.year
        """,
        part.OBS, part.POPULATION,
    ),
)
def enrichment_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series and period in the text layer, the typed layer, the reusable table and a published answer.

    The two answers take different ways: one is cut from the enriched observations here, the other is
    read back from what was published, some years of which are stale.
    """
    obs = written(views.observations(spark, sf_dir), "observations")
    population = views.yearly_population(spark, sf_dir)
    people = population.select("year", F.round("population").cast("bigint").alias("population"))
    bodies = population.select(
        F.to_json(F.struct(F.array(F.struct(F.col("year").alias("Year"), F.col("population").alias("Population")))
                           .alias("data"))).alias("raw_json")
    )
    from_bodies = snapshots.explode_list(bodies, "struct<Year: bigint, Population: double>").select(
        F.col("_record.Year").cast("int").alias("year"),
        F.round("_record.Population").cast("bigint").alias("population"),
    )
    raw = views.raw_observations(obs).where((F.trim("series_id") == SERIES) & (F.trim("period") == PERIOD))
    from_text = raw.select(F.trim("year").cast("int").alias("year"), F.trim("value").cast("double").alias("value"))
    chosen = obs.where((F.col("series_id") == SERIES) & (F.col("period") == PERIOD))
    enriched = answers.observations_with_population(obs, people, expect_unique=True)
    generic = enriched.where((F.col("series_id") == SERIES) & (F.col("period") == PERIOD))
    stale = F.expr(STALE)
    old = answers.one_series_and_period(enriched, SERIES, PERIOD).withColumns({
        "value": (F.col("value") + F.when(stale, F.expr("0.125BD")).otherwise(F.expr("0BD"))).cast("decimal(18,3)"),
        "population": F.col("population") + F.when(stale, 7).otherwise(0),
    })
    specific = publish.publish(old, scratch_path(spark, "one-series")).data
    cases = spark.sql(f"SELECT * FROM VALUES {YEAR_CASES} AS t(test_case, test_name, year)")
    traced = compare.enrichment_trace(cases, from_text, from_bodies, chosen, generic, specific)
    gaps = [name for name in traced.columns if name.endswith("_diff")]
    return traced.withColumns({name: F.col(name).cast("double") for name in gaps})


@query(
    "unmatched_years",
    with_parts(
        f"SELECT p.year, p.population FROM population p LEFT JOIN (SELECT year FROM obs WHERE series_id = '{SERIES}' "
        f"AND period = '{PERIOD}') o ON o.year = p.year WHERE o.year IS NULL",
        part.OBS, part.POPULATION,
    ),
)
def unmatched_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.observations(spark, sf_dir)
    chosen = obs.where((F.col("series_id") == SERIES) & (F.col("period") == PERIOD))
    return enrich.unmatched(views.yearly_population(spark, sf_dir), chosen, "year")


@query(
    "sort_if_present",
    with_parts(
        "SELECT series_id, best_year, yearly_value, value_method FROM best ORDER BY series_id, best_year",
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST,
    ),
)
def sort_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = answers.best_years(answers.series_years(views.observations(spark, sf_dir)))
    narrow = best.select("series_id", "best_year", "yearly_value", "value_method")
    return present.sort_if_present(narrow, ["series_id", "best_year", "year"])


@query(
    "render_rows",
    with_parts(
        """
        SELECT '| ' || coalesce(b.series_id, '') || ' | ' || coalesce(l.sector_name, '') || ' | ' || coalesce(l.measure_text, '')
               || ' | ' || coalesce(l.class_text, '') || ' | ' || coalesce(l.duration_text, '')
               || ' | ' || coalesce(l.seasonal_text, '') || ' | ' || b.value_method || ' | ' || b.best_year
               || ' | ' || b.yearly_value || ' | ' || coalesce(replace(l.human_readable_label, '|', '\\|'), '')
               || ' | ' || CASE l._label_lookup_complete WHEN TRUE THEN 'True' WHEN FALSE THEN 'False' ELSE '' END || ' |' AS line
        FROM best b LEFT JOIN labelled l ON l.series_id = b.series_id
        """,
        part.OBS, part.ROLLUP, part.YEARLY, part.BEST, part.LABELS,
    ),
)
def render_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-year answer as table lines, written as text and read back."""
    path = scratch_path(spark, "report")
    present.render_rows(_labelled_best(spark, sf_dir)).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")
