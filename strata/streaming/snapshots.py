"""Incremental ingestion of whole snapshot files, each exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.naming import SnapshotName, base_name
from strata.operators.quality import Expectation, RuleOutcome, enforce, outcomes_of, violation_counts
from strata.operators.quality_log import record
from strata.session import has_path, small_frame

# The columns of Spark's binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def snapshot_stream(spark: SparkSession, folder: str, glob: str, recursive: bool = False,
                    max_files: int = 1000) -> DataFrame:
    """Stream of whole files; ``max_files`` bounds a micro-batch, not the stream."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
    )


def identify(df: DataFrame, naming: SnapshotName, name: Column | None = None) -> DataFrame:
    """Add ``source_file``, ``fetched_at_utc``, its day ``fetched_on`` and the decoded ``raw_json``."""
    source = base_name(F.col("path")) if name is None else name
    named = df.withColumn("source_file", source)
    timed = named.withColumn("fetched_at_utc", naming.fetched_at(F.col("source_file")))
    return timed.withColumns(
        {
            "fetched_on": F.substring(naming.fetched_text(F.col("source_file")), 1, 10),
            "raw_json": F.decode("content", "UTF-8"),
        }
    )


#: Folder level of a micro-batch in a table, and the columns of its rule counts.
BATCH = "ingest_batch"
COUNTS = f"rule string, mode string, checked bigint, violations bigint, newest string, {BATCH} string"


def counts_path(table: str) -> str:
    return f"{table.rstrip('/')}_rule_counts"


def write_batch(batch: DataFrame, key: str, table: str, rules: Sequence[Expectation], carrier: str,
                partition_by: Sequence[str]) -> list[RuleOutcome]:
    """Write a micro-batch's rows, then what its rules counted, each into a folder named after the batch.

    Both replace what an earlier attempt of the same batch left, so a batch that is repeated after a crash, whatever
    it had come to, leaves the same rows and counts as one that was not disturbed.
    """
    spark = batch.sparkSession
    newest = F.max(F.col(partition_by[0]).cast("string")) if partition_by else F.lit(None).cast("string")
    seen = Observation()
    checked = enforce(batch.observe(seen, *violation_counts(rules), newest.alias("_newest")), rules, carrier)
    writer = checked.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{table}/{BATCH}={key}")
    counted = seen.get
    outcomes = outcomes_of(rules, counted)
    rows = [(o.name, o.mode, o.checked, o.violations, counted["_newest"]) for o in outcomes]
    kept = small_frame(spark, rows, COUNTS.rsplit(",", 1)[0])
    kept.coalesce(1).write.mode("overwrite").parquet(f"{counts_path(table)}/{BATCH}={key}")
    return outcomes


def ingest_available(df: DataFrame, table: str, checkpoint: str, rules: Sequence[Expectation] = (),
                     carrier: str = "source_file", partition_by: Sequence[str] = (), log: str | None = None,
                     dataset: str = "") -> list[RuleOutcome]:
    """Append everything that is available now to a parquet table and return the rules' counts over this run.

    Which files are done is kept in ``checkpoint``; rows and counts of a micro-batch are keyed by the stream's
    identity there and the number of the batch, so a run that dies anywhere and is repeated adds nothing
    twice and loses no count. :func:`rule_totals` has the counts of all runs, whatever became of their drivers. A
    violated failing rule stops the stream with its micro-batch uncommitted and without rows. With ``log`` every
    micro-batch is a version of ``dataset`` in the quality log, one that was stopped included.
    """
    totals: dict[str, RuleOutcome] = {rule.name: RuleOutcome(rule.name, rule.mode, 0, 0) for rule in rules}

    def take(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        key = f"{stream}-{number:010d}"
        try:
            outcomes = write_batch(batch, key, table, rules, carrier, partition_by)
        except Exception:
            if log:
                counted = batch.agg(*violation_counts(rules)).first()
                record(batch.sparkSession, log, dataset or table, f"{key}-stopped", outcomes_of(rules, counted.asDict()))
            raise
        if log:
            record(batch.sparkSession, log, dataset or table, key, outcomes)
        for o in outcomes:
            before = totals[o.name]
            totals[o.name] = RuleOutcome(o.name, o.mode, before.checked + o.checked, before.violations + o.violations)

    query = df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return list(totals.values())


def batch_counts(spark: SparkSession, table: str) -> DataFrame:
    """What the rules counted in every micro-batch of all runs (no rows before the first)."""
    path = counts_path(table)
    if not has_path(spark, path):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(path)


def rule_totals(spark: SparkSession, table: str) -> DataFrame:
    """``rule, mode, checked, violations`` over all micro-batches since the table began."""
    return batch_counts(spark, table).groupBy("rule", "mode").agg(
        F.sum("checked").alias("checked"), F.sum("violations").alias("violations"))


def newest_ingested(spark: SparkSession, table: str) -> str | None:
    """The largest value of the first partition column that any micro-batch brought, from the counts alone."""
    return batch_counts(spark, table).agg(F.max("newest")).first()[0]


def read_ingested(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of all micro-batches; none before the first."""
    if not has_path(spark, table):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table)
