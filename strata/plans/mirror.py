"""Keeping a landing folder in step with a source's directory listing.

Fetching is left to the caller: :func:`compare_listing` says what to fetch and what to
drop, :func:`record_run` checks what arrived and moves the manifest on.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.enrich import one_per_key
from strata.operators.manifest import STATE, change_events, check_fetched, content_changes, reconcile
from strata.operators.publish import Published, append_snapshot, publish
from strata.operators.quality import FAIL, Expectation
from strata.session import scratch_path, written
from strata.sources.listing import discover_files, empty_listings, listing_rows

MANIFEST = (
    "file_name string, source_url string, source_last_modified string, source_size_bytes bigint, "
    "content_sha256 string, first_seen_at timestamp, last_seen_at timestamp, last_downloaded_at timestamp, "
    "removed_at timestamp, status string"
)
FETCH_RULES = [Expectation("fetched_size_matches_listing", "size_matches", FAIL)]


class EmptyListing(ValueError):
    """A directory listing names no file: the source changed, it was not emptied."""


@dataclass(frozen=True)
class Mirror:
    base_url: str
    folder: str
    state: str
    view: str

    @property
    def log(self) -> str:
        return f"{self.state.rstrip('/')}/events"


def read_manifest(spark: SparkSession, mirror: Mirror) -> DataFrame:
    """The state after the last recorded run, empty before the first."""
    if spark.catalog.tableExists(mirror.view):
        return spark.table(mirror.view)
    return spark.createDataFrame([], MANIFEST)


def compare_listing(spark: SparkSession, mirror: Mirror, page: DataFrame, run_time: Column) -> DataFrame:
    """What happened to every file according to ``page`` (page_id, html), the newest listing.

    A name that is listed twice is an error, as two rows of it would multiply. The result is written out: it must stay what it was while files are fetched and dropped.
    """
    if not empty_listings(page).isEmpty():
        raise EmptyListing(f"no file is listed at {mirror.base_url}")
    listed = one_per_key(listing_rows(page, mirror.base_url).drop("page_id"), "file_name")
    local = discover_files(spark, mirror.folder).select("file_name", F.col("size_bytes").alias("local_size_bytes"))
    return written(reconcile(read_manifest(spark, mirror), listed, local, run_time), "reconciled")


def record_run(spark: SparkSession, mirror: Mirror, reconciled: DataFrame, run_time: Column, run_id: str,
               fetched_since: datetime) -> Published:
    """Check the fetched files, log the changes under ``run_id`` and publish the next manifest.

    A file that is missing or has another size than listed stops the run before anything is recorded. The
    log comes first: a run that dies before the manifest moves on is repeated and replaces its own events.
    Files from before ``fetched_since`` are not read: the source skips them by their modification time.
    """
    files = spark.read.format("binaryFile").load(mirror.folder)
    files = files.where(F.col("modificationTime") >= F.lit(fetched_since))
    contents = files.select(F.substring_index("path", "/", -1).alias("file_name"), "content")
    checked = publish(check_fetched(reconciled, contents), scratch_path(spark, "fetched"), FETCH_RULES).data

    fetched = checked.select("file_name", F.col("content_sha256").alias("_hash"))
    moved_on = reconciled.join(fetched, "file_name", "left").withColumn(
        "content_sha256", F.coalesce("_hash", "content_sha256")
    )
    columns = ["file_name", "source_url", *STATE[:2], "content_sha256", *STATE[3:], "status"]
    append_snapshot(change_events(reconciled, run_time), mirror.log, run_id, again=True)
    return publish(moved_on.select(*columns), f"{mirror.state}/manifest", (), mirror.view, "Files of the source.")


def changed_listing(page: DataFrame, stored: DataFrame) -> DataFrame:
    """The listing pages to keep, because their content differs from the stored one."""
    return content_changes(page.withColumnRenamed("html", "content"), stored, name="page_id")
