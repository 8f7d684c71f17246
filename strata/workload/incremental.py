"""Registered queries of what is kept between runs, and of inputs that come in many pieces."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import folder_name
from strata.operators import checksums, conform, contracts, manifest, moments, publish, quality, quality_log, rollup, yearly_state
from strata.operators.buckets import BucketedTable, replaced
from strata.operators.key_index import KeyIndex
from strata.session import scratch_path
from strata.sources import folders, listing
from strata.streaming import snapshots as streams
from strata.workload import oracle_parts as part
from strata.workload import views
from strata.workload.registry import query, with_parts

# ---------------------------------------------------------------- many files in one job


def land_customers(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Customers as files of every nation's folder, in two layouts: odd keys lack the segment and have another order."""
    key = F.col("c_custkey")
    blank_name = F.when(key % 7 == 0, "  ").otherwise(views.padded(F.col("c_name")))
    raw = views.raw_table(spark, sf_dir, "customer").select(
        "c_custkey", blank_name.alias(" C_NAME "), "c_acctbal", F.col("c_mktsegment").alias("C_MktSegment "),
        F.trim("c_nationkey").alias("nation"), F.trim("c_custkey").cast("long").alias("_key"))
    even, odd = raw.where("_key % 2 = 0"), raw.where("_key % 2 = 1")
    for layout in (even.drop("_key"), odd.select("c_acctbal", "c_custkey", "` C_NAME `", "nation")):
        landing = layout.write.partitionBy("nation").mode("append").option("maxRecordsPerFile", 500)
        landing.csv(folder, sep="\t", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query(
    "many_files",
    """
    SELECT CAST(c_nationkey AS VARCHAR) AS dataset, CAST(c_custkey AS VARCHAR) AS c_custkey,
           CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name, CAST(CAST(c_acctbal AS DECIMAL(18,3)) AS VARCHAR) AS c_acctbal,
           CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment, TRUE AS is_from_its_folder
    FROM customer
    """,
)
def many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's values under the names of its own header, whatever the number of files, in a fixed number of jobs."""
    landing = scratch_path(spark, "customers-by-nation")
    land_customers(spark, sf_dir, landing)
    landed = folders.land_lines(spark, landing, lambda name, path: folder_name(path), recursive=True)
    rows = folders.by_header(landed)
    return rows.select(
        "dataset", "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        (folder_name(F.col("_source_path")) == F.col("dataset")).alias("is_from_its_folder"))


@query(
    "many_files_flags",
    """
    SELECT CAST(c_nationkey AS VARCHAR) AS dataset, c_custkey % 2 = 0 AS expected_schema, c_custkey % 7 <> 0 AS non_null_key,
           count(*) AS n FROM customer GROUP BY ALL
    """,
)
def many_files_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout flags of rows from many files, each held against the contract of its own file's name."""
    landing = scratch_path(spark, "customers-by-nation")
    land_customers(spark, sf_dir, landing)
    landed = folders.land_lines(spark, landing, lambda name, path: folder_name(path), recursive=True)
    layout = contracts.Contract.of("c_custkey c_name c_acctbal c_mktsegment", "c_custkey c_name")
    named = folders.Landed(landed.lines, landed.headers.withColumn("file_name", F.lit("customers")), landed.separator)
    rows = folders.by_header(named, {"customers": layout})
    return rows.groupBy("dataset", F.col(contracts.SCHEMA_FLAG).alias("expected_schema"), F.col(contracts.KEY_FLAG).alias("non_null_key")).agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- what checks counted, kept

LOGGED_RULES = [
    quality.Expectation("priority_filled", "trim(priority) <> ''"),
    quality.Expectation("total_known", "total IS NOT NULL"),
    quality.Expectation("not_after_1996", "ordered_on < '1997-01-01'", quality.FAIL),
]
#: Each version of the orders reaches to here; the last one breaks the failing rule.
UNTIL = ("1994-01-01", "1996-01-01", "2100-01-01")

LOGGED = f"""
versions AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{day}')" for i, day in enumerate(UNTIL, 1))}) v(run, until)),
rules AS (SELECT * FROM (VALUES ('priority_filled', 'warn'), ('total_known', 'warn'), ('not_after_1996', 'fail')) r(rule, mode)),
outcomes AS (
    SELECT ordered_on, unnest(['priority_filled', 'total_known', 'not_after_1996']) AS rule,
           unnest([coalesce(priority, '') = '', total IS NULL, ordered_on >= '1997-01-01']) AS bad FROM typed),
logged AS (
    SELECT run, r.rule, r.mode, count(o.rule) AS checked, count(*) FILTER (WHERE bad) AS violations
    FROM versions CROSS JOIN rules r LEFT JOIN outcomes o ON o.rule = r.rule AND ordered_on < until GROUP BY ALL),
histories AS (
    SELECT *, CASE WHEN checked > 0 THEN violations / checked END AS share,
           max(CASE WHEN mode = 'fail' THEN violations END) OVER (PARTITION BY run) = 0 AS gate_open
    FROM logged)
"""


def logged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after three versions of the typed orders, the last of them refused."""
    location, log = scratch_path(spark, "logged-orders"), scratch_path(spark, "quality-log")
    typed = conform.conform(views.raw_orders(spark, sf_dir), views.ORDERS_SPEC)
    for until in UNTIL:
        try:
            publish.publish(typed.where(F.col("ordered_on") < until), location, LOGGED_RULES, log=log)
        except quality.GateError:
            if until != UNTIL[-1]:
                raise
    return quality_log.entries(spark, log)


@query(
    "quality_trend",
    with_parts(
        "SELECT CAST(run AS INTEGER) AS run, rule, mode, checked, violations, gate_open, share, "
        "share - lag(share) OVER (PARTITION BY rule ORDER BY run) AS change FROM histories", part.TYPED_ORDERS, LOGGED),
)
def quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the violations of every rule developed over the versions of a dataset, refused ones included."""
    found = quality_log.trend(logged_versions(spark, sf_dir))
    return found.select("run", "rule", "mode", "checked", "violations", "gate_open", "share", "change")


@query(
    "quality_last_failure",
    with_parts(
        "SELECT rule, count(*) AS runs, count(*) FILTER (WHERE violations > 0) AS failed_runs, "
        "CAST(max(run) FILTER (WHERE violations > 0) AS INTEGER) AS last_run, "
        "arg_max(violations, run) FILTER (WHERE violations > 0) AS last_violations, "
        "arg_max(gate_open, run) FILTER (WHERE violations > 0) AS last_gate_open, "
        "CAST(max(run) - max(run) FILTER (WHERE violations > 0) AS INTEGER) AS runs_since FROM histories GROUP BY rule",
        part.TYPED_ORDERS, LOGGED),
)
def quality_last_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each rule was last violated and how long ago that is, in versions."""
    found = quality_log.last_failure(logged_versions(spark, sf_dir))
    return found.select("rule", "runs", "failed_runs", "last_run", "last_violations", "last_gate_open", "runs_since")


STREAM_RULES = [
    quality.Expectation("raw_json_not_null", "raw_json IS NOT NULL", quality.FAIL),
    quality.Expectation("many_events", "CAST(trim(raw_json) AS INT) >= 100"),
]


class Lost(RuntimeError):
    """What a driver that dies looks like from inside."""


@query(
    "stream_rule_totals",
    """
    SELECT rule, mode, CAST(sum(checked) AS BIGINT) AS checked, CAST(sum(violations) AS BIGINT) AS violations,
           (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events) AS newest, (SELECT count(DISTINCT date_trunc('day', ts)) FROM events) AS n_rows
    FROM (
        SELECT 'raw_json_not_null' AS rule, 'fail' AS mode, count(DISTINCT date_trunc('day', ts)) AS checked, 0 AS violations FROM events
        UNION ALL
        SELECT 'many_events', 'warn', count(*), sum(CASE WHEN n >= 100 THEN 0 ELSE 1 END)
        FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) d
    ) r GROUP BY rule, mode
    """,
)
def stream_rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all rules from what the micro-batches stored, though a run dies after it wrote rows and counts of
    a batch and before that is committed, and another takes it up.
    """
    naming = views.EVENT_SNAPSHOT
    landing, raw, checkpoint = (scratch_path(spark, name) for name in ("landing", "raw", "checkpoint"))
    snapshot = naming.name_for(F.date_trunc("day", "ts")).alias("snapshot")
    bodies = views.table(spark, sf_dir, "events").groupBy(snapshot).agg(F.count("*").cast("string").alias("line"))
    bodies.repartition("snapshot").write.partitionBy("snapshot").text(landing)
    files = streams.snapshot_stream(spark, landing, "*.txt", recursive=True, max_files=12)
    found = streams.identify(files, naming, folder_name(F.col("path"))).select("source_file", "fetched_on", "raw_json")

    def dying(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        streams.write_batch(batch, f"{stream}-{number:010d}", raw, STREAM_RULES, "source_file", ["fetched_on"])
        if number == 1:
            raise Lost

    lost = found.writeStream.foreachBatch(dying).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        lost.awaitTermination()
    except StreamingQueryException:
        pass
    streams.ingest_available(found, raw, checkpoint, STREAM_RULES, partition_by=["fetched_on"])
    stored = streams.read_ingested(spark, raw, found.schema)
    newest = streams.newest_ingested(spark, raw)
    return streams.rule_totals(spark, raw).withColumns({"newest": F.lit(newest), "n_rows": F.lit(stored.count()).cast("bigint")})


# ---------------------------------------------------------------- differences by checksums

CHANGED_LINES = """
before AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem),
after AS (
    SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 997 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag
    FROM lineitem WHERE l_orderkey % 1009 <> 0
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 1013 = 0),
signed AS (
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, sum(side) AS surplus
    FROM (SELECT *, 1 AS side FROM before UNION ALL SELECT *, -1 FROM after) s GROUP BY ALL HAVING sum(side) <> 0)
"""


def two_states_of_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items before and after some were changed, some removed and some repeated."""
    before = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    changed = F.when(F.col("l_orderkey") % 997 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    kept = before.withColumn("l_quantity", changed).where("l_orderkey % 1009 <> 0")
    return before, kept.unionByName(before.where("l_orderkey % 1013 = 0"))


@query("tree_diff", with_parts("SELECT * EXCLUDE (surplus), CAST(surplus AS BIGINT) AS surplus FROM signed", CHANGED_LINES))
def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one state has more often than the other; only buckets whose sums differ are moved."""
    return checksums.tree_diff(*two_states_of_lines(spark, sf_dir), keys=["l_orderkey"])


@query(
    "multiset_diff_counts",
    with_parts(
        "SELECT surplus > 0 AS only_before, count(*) AS different, CAST(sum(abs(surplus)) AS BIGINT) AS copies FROM signed GROUP BY ALL",
        CHANGED_LINES),
)
def multiset_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows, and how many copies of them, one side has more."""
    diff = checksums.signed_diff(*two_states_of_lines(spark, sf_dir))
    return diff.groupBy((F.col("surplus") > 0).alias("only_before")).agg(
        F.count(F.lit(1)).alias("different"), F.sum(F.abs("surplus")).alias("copies"))


# ---------------------------------------------------------------- yearly values and moments from increments

#: A late correction: the second quarters of 1995 of every fourth customer gain one, the third ones of every ninth go.
CORRECTED = part.OBS.replace("\nobs AS (", "\nplain AS (") + """,
obs AS (
    SELECT series_id, year, period,
           CAST(CASE WHEN year = 1995 AND period = 'Q02' AND CAST(series_id[2:] AS BIGINT) % 4 = 0 THEN value + 1 ELSE value END
                AS DECIMAL(18,3)) AS value
    FROM plain WHERE NOT (year = 1995 AND period = 'Q03' AND CAST(series_id[2:] AS BIGINT) % 9 = 0))
"""
STATE_COLUMNS = "series_id, year, quarter_count, _quarterly_sum, _q05_count, _q05_value, _unexpected_period_count, yearly_value, value_method"


@query("yearly_state", with_parts(f"SELECT {STATE_COLUMNS} FROM yearly", CORRECTED, part.ROLLUP, part.YEARLY))
def kept_yearly_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly values after three increments, of which the last also reaches back, a correction and a withdrawal."""
    obs = views.observations(spark, sf_dir)
    number = F.substring("series_id", 2, 20).cast("bigint")
    state = yearly_state.YearlyState(spark, scratch_path(spark, "yearly-state"), buckets=16)
    late = (F.col("period") == "Q01") & (number % 2 == 0)
    state.add(1, obs.where((F.col("year") < 1995) & ~late))
    state.add(2, obs.where((F.col("year") >= 1995) & (F.col("year") < 1997)))
    state.add(3, obs.where((F.col("year") >= 1997) | ((F.col("year") < 1995) & late)))
    old = obs.where("year = 1995")
    state.add(4, old.where((F.col("period") == "Q02") & (number % 4 == 0)).withColumn("value", F.col("value") + 1), corrections=True)
    state.withdraw(5, old.where((F.col("period") == "Q03") & (number % 9 == 0)))
    state.add(3, obs)  # a repeated increment counts once
    return rollup.yearly_values(state.rollup()).select(*STATE_COLUMNS.split(", "))


MOMENTS_SQL = """
    SELECT o_orderpriority AS nation_id, o_orderstatus AS nation, count(*) AS n, round(avg(o_totalprice), 4) AS mean_population,
           round(stddev_samp(o_totalprice), 4) AS stddev_population
    FROM orders WHERE year(o_orderdate) IN (1993, 1996, 1997, 1998) GROUP BY o_orderpriority, o_orderstatus
"""


@query("range_stats_from_moments", MOMENTS_SQL)
def range_stats_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of two separate ranges together, from moments that were stored per year."""
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("nation_id"), F.col("o_orderstatus").alias("nation"), F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("population"))
    stored = publish.publish(moments.moments(orders, ["nation_id", "nation", "year"]), scratch_path(spark, "moments")).data
    wanted = stored.where("year = 1993 OR year BETWEEN 1996 AND 1998")
    found = moments.mean_and_deviation(moments.merged(wanted, ["nation_id", "nation"]))
    return found.withColumns({name: F.round(name, 4) for name in ("mean_population", "stddev_population")})


# ---------------------------------------------------------------- manifests in buckets, listings in pieces

RUN_TIME = "2002-01-01 00:00:00"


@query(
    "manifest_buckets",
    with_parts(
        f"""
        SELECT file_name, coalesce(new_modified, old_modified) AS source_last_modified, coalesce(new_size, old_size) AS source_size_bytes,
               CASE WHEN listed THEN 'active' ELSE 'removed' END AS status, coalesce(first_seen_at, TIMESTAMP '{RUN_TIME}') AS first_seen_at,
               CASE WHEN action IN ('new', 'changed') THEN TIMESTAMP '{RUN_TIME}' ELSE last_seen_at END AS last_seen_at,
               CASE WHEN action IN ('new', 'changed') THEN TIMESTAMP '{RUN_TIME}' ELSE last_downloaded_at END AS last_downloaded_at,
               CASE action WHEN 'removed' THEN TIMESTAMP '{RUN_TIME}' WHEN 'absent' THEN removed_at END AS removed_at
        FROM compared
        """,
        part.FILES,
    ),
)
def manifest_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of the orders' files brought up to a new listing, in buckets of which only touched ones are rewritten."""
    known, listed, local = views.order_files(spark, sf_dir)
    schema = manifest.MANIFEST.replace("timestamp", "timestamp_ntz")
    table = BucketedTable(spark, scratch_path(spark, "manifest"), ("file_name",), schema, 32)
    table.update(1, known.select(*[column.split()[0] for column in schema.split(", ")]), replaced(["file_name"]))
    manifest.update_manifest(table, listed, local, F.lit(RUN_TIME).cast("timestamp_ntz"), 2)
    return table.read()


@query(
    "listing_pieces",
    """
    SELECT 'p' || p_partkey || e.ending AS file_name, e.folder || 'p' || p_partkey || e.ending AS source_url,
           CASE WHEN e.ending = '.data' THEN '12/31/2024 11:59 PM' ELSE '1/' || (p_partkey % 28 + 1) || '/2024  9:05 AM' END AS source_last_modified,
           CAST(p_size + e.more AS BIGINT) AS source_size_bytes
    FROM part, (VALUES ('.data', 'https://example.org/pub/new/', 3), ('.series', 'https://example.org/pub/time/', 1),
                       ('.txt', 'https://example.org/pub/', 2)) e(ending, folder, more)
    """,
)
def listing_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page that lists the files of all parts, read in pieces at its own line breaks."""
    path = scratch_path(spark, "listing-page")
    views.listing_pages(spark, sf_dir).select("html").coalesce(1).write.text(path)
    rows = listing.listing_rows_of_files(spark, path, "https://example.org/pub/time/")
    return rows.drop("page")


# ---------------------------------------------------------------- unique keys across versions


@query(
    "key_index",
    """
    WITH dealt AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderkey % 3 + 1 AS BIGINT) AS increment FROM orders)
    SELECT o_orderkey, increment, count(*) OVER (PARTITION BY increment, o_custkey, o_orderstatus) = 1
           AND min(increment) OVER (PARTITION BY o_custkey, o_orderstatus) = increment AS _natural_key_unique
    FROM dealt
    """,
)
def key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three increments; a customer's status is its key, and an increment looks up its own keys only."""
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_orderkey") % 3 + 1).cast("bigint").alias("increment"))
    index = KeyIndex(spark, scratch_path(spark, "key-index"), buckets=16)
    flagged = [index.flag_increment(orders.where(F.col("increment") == n), ["o_custkey", "o_orderstatus"], n) for n in (1, 2, 3)]
    return flagged[0].unionByName(flagged[1]).unionByName(flagged[2]).select("o_orderkey", "increment", "_natural_key_unique")
