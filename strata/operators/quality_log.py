"""A log of what every check counted: appended to for each version of a dataset, open or closed, and never rewritten."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.quality import FAIL, RuleOutcome
from strata.session import small_frame

ENTRIES = ("dataset string, version string, rule string, mode string, checked bigint, violations bigint, gate_open boolean, "
           "recorded_at timestamp")


def record(spark: SparkSession, log: str, dataset: str, version: str, outcomes: Sequence[RuleOutcome],
           at: datetime | None = None) -> None:
    """Add the outcomes of one version, one row per rule, as one file in a folder of its own.

    Publishers that record at the same time therefore do not meet in one folder's unfinished files. Called before readers see the version, so a version in use is always in the log; one whose gate closed is
    too. Recording a version again adds nothing to what :func:`entries` shows.
    """
    gate_open = not any(o.mode == FAIL and o.violations for o in outcomes)
    at = at or datetime.now(timezone.utc)
    rows = [(dataset, version, o.name, o.mode, o.checked, o.violations, gate_open, at) for o in outcomes]
    if rows:
        small_frame(spark, rows, ENTRIES).coalesce(1).write.parquet(f"{log.rstrip('/')}/{uuid.uuid4().hex}")


def entries(spark: SparkSession, log: str) -> DataFrame:
    """Every outcome once: of a version that was recorded again after a failure the first record counts."""
    kept = spark.read.schema(ENTRIES).option("recursiveFileLookup", "true").parquet(log)
    first = F.min_by(F.struct("mode", "checked", "violations", "gate_open", "recorded_at"), "recorded_at").alias("first")
    return kept.groupBy("dataset", "version", "rule").agg(first).select("dataset", "version", "rule", "first.*")


def trend(log: DataFrame) -> DataFrame:
    """Each outcome with its place in the history of its rule and how the share of violations changed.

    ``run`` counts a dataset's versions by time; ``share`` is NULL for a version without rows, ``change`` also for the first.
    """
    history = Window.partitionBy("dataset", "rule").orderBy("recorded_at", "version")
    share = F.when(F.col("checked") > 0, F.col("violations") / F.col("checked"))
    placed = log.withColumn("share", share).withColumn("run", F.row_number().over(history))
    return placed.withColumn("change", F.col("share") - F.lag("share").over(history))


def last_failure(log: DataFrame) -> DataFrame:
    """Per dataset and rule: number of versions checked and violated, the last violated one, and how many came after it."""
    violated = F.col("violations") > 0
    last = F.max_by(F.struct("version", "run", "violations", "gate_open", "recorded_at"), F.when(violated, F.col("run"))).alias("last")
    found = trend(log).groupBy("dataset", "rule").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(violated).alias("failed_runs"), last, F.max("run").alias("_latest"))
    return found.select(
        "dataset", "rule", "runs", "failed_runs", F.col("last.version").alias("last_version"), F.col("last.run").alias("last_run"),
        F.col("last.violations").alias("last_violations"), F.col("last.gate_open").alias("last_gate_open"),
        F.col("last.recorded_at").alias("last_at"), (F.col("_latest") - F.col("last.run")).alias("runs_since"))
