"""What changed between the files known so far and a new listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.buckets import BucketedTable, replaced
from strata.session import written

ACTIVE, REMOVED = "active", "removed"


STATE = ("source_last_modified", "source_size_bytes", "status", "first_seen_at", "last_seen_at",
         "last_downloaded_at", "removed_at")


def reconcile(manifest: DataFrame, listing: DataFrame, local: DataFrame, run_time: Column) -> DataFrame:
    """Compare the manifest with a new listing; one row per file with its ``action`` and next state.

    ``manifest``: file_name and the columns of ``STATE``. ``listing``: file_name,
    source_last_modified, source_size_bytes. ``local``: file_name, local_size_bytes of the
    copies at hand. Each has one row per file name. Further columns of the manifest are
    carried along, those of the listing replace them for the files it names.

    A file is ``unchanged`` only if it was active with the same time and size and its copy
    has that size; otherwise ``new`` if never seen, else ``changed``, also when a removed
    file returns. An active file not listed is ``removed``; one removed earlier and still
    not listed is ``absent`` and stays as it is.
    """
    known = _packed(manifest, "old")
    both = known.join(_packed(listing.join(local, "file_name", "left"), "now"), "file_name", "full_outer")
    was_known, listed = F.col("old").isNotNull(), F.col("now").isNotNull()
    same = F.coalesce(
        (F.col("old.status") == ACTIVE)
        & (F.col("old.source_last_modified") == F.col("now.source_last_modified"))
        & (F.col("old.source_size_bytes") == F.col("now.source_size_bytes"))
        & (F.col("now.local_size_bytes") == F.col("now.source_size_bytes")),
        F.lit(False),
    )
    action = (
        F.when(listed & ~was_known, "new")
        .when(listed & same, "unchanged")
        .when(listed, "changed")
        .when(F.col("old.status") == ACTIVE, "removed")
        .otherwise("absent")
    )
    fetched = F.col("action").isin("new", "changed")
    removed_at = F.when(F.col("action") == "removed", run_time).otherwise(F.col("old.removed_at"))
    return both.withColumn("action", action).select(
        "file_name",
        "action",
        F.coalesce("now.source_last_modified", "old.source_last_modified").alias("source_last_modified"),
        F.coalesce("now.source_size_bytes", "old.source_size_bytes").alias("source_size_bytes"),
        F.coalesce(F.col("old.first_seen_at"), run_time).alias("first_seen_at"),
        F.when(listed, run_time).otherwise(F.col("old.last_seen_at")).alias("last_seen_at"),
        F.when(fetched, run_time).otherwise(F.col("old.last_downloaded_at")).alias("last_downloaded_at"),
        F.when(~listed, removed_at).alias("removed_at"),
        F.when(listed, F.lit(ACTIVE)).otherwise(F.lit(REMOVED)).alias("status"),
        *_carried(manifest, listing),
    )


MANIFEST = ("file_name string, source_last_modified string, source_size_bytes bigint, status string, first_seen_at timestamp, "
            "last_seen_at timestamp, last_downloaded_at timestamp, removed_at timestamp")


def update_manifest(table: BucketedTable, listing: DataFrame, local: DataFrame, run_time: Column, number: int) -> DataFrame:
    """Bring a bucketed manifest up to a new listing; the files that are new, changed or gone, with their ``action``.

    Only buckets of such files are rewritten, and a listing in which nothing changed writes nothing. A file that
    stays as it is keeps its row, so its ``last_seen_at`` is that of its last change; that it was listed since
    follows from the log of runs. The changes are written before the manifest, so whoever logs or fetches them
    can do so again after a crash.
    """
    names = [part.split()[0] for part in MANIFEST.split(", ")]
    reconciled = reconcile(table.read(), listing, local, run_time)
    changed = written(reconciled.where(F.col("action").isin("new", "changed", "removed")), "manifest-changes")
    if not changed.isEmpty():
        table.update(number, changed.select(*names), replaced(["file_name"]))
    return changed


def _packed(df: DataFrame, name: str) -> DataFrame:
    return df.select("file_name", F.struct(*[c for c in df.columns if c != "file_name"]).alias(name))


def _carried(manifest: DataFrame, listing: DataFrame) -> list[Column]:
    """Columns beyond the required ones: the listing's value first, then the manifest's."""
    done = {"file_name", *STATE}
    names = dict.fromkeys([*listing.columns, *manifest.columns])
    sides = [("now", listing.columns), ("old", manifest.columns)]
    return [
        F.coalesce(*[F.col(f"{side}.{name}") for side, columns in sides if name in columns]).alias(name)
        for name in names
        if name not in done
    ]


def check_fetched(reconciled: DataFrame, contents: DataFrame) -> DataFrame:
    """The files that had to be fetched, with the hash of what arrived and whether its size is right.

    ``contents`` has file_name and content. A file that did not arrive has no hash and a
    false ``size_matches``, so one failing rule on that column covers both.
    """
    arrived = contents.select(
        "file_name",
        content_hash(F.col("content")).alias("content_sha256"),
        F.octet_length("content").cast("bigint").alias("fetched_size_bytes"),
    )
    wanted = reconciled.where(F.col("action").isin("new", "changed")).select("file_name", "action", "source_size_bytes")
    matches = F.coalesce(F.col("fetched_size_bytes") == F.col("source_size_bytes"), F.lit(False))
    return wanted.join(arrived, "file_name", "left").withColumn("size_matches", matches)


def change_events(reconciled: DataFrame, run_time: Column) -> DataFrame:
    """The log entries of one run: a row for every new, changed or removed file."""
    return reconciled.where(F.col("action").isin("new", "changed", "removed")).select(
        run_time.alias("observed_at"), F.col("action").alias("event_type"), "file_name"
    )


def change_summary(reconciled: DataFrame) -> DataFrame:
    """How many files had each outcome, zeros included, and how many were fetched."""
    counted = [F.count_if(F.col("action") == name).alias(name) for name in ("new", "changed", "unchanged", "removed")]
    return reconciled.agg(*counted).withColumn("downloads", F.col("new") + F.col("changed"))


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def content_changes(incoming: DataFrame, stored: DataFrame, name: str = "file_name",
                    content: str = "content", stored_hash: str = "content_sha256") -> DataFrame:
    """Incoming artifacts to be rewritten: those not stored, or stored with another hash."""
    hashed = incoming.withColumn("_incoming_hash", content_hash(F.col(content)))
    before = stored.select(name, F.col(stored_hash).alias("_stored_hash"))
    same = F.col("_incoming_hash").eqNullSafe(F.col("_stored_hash"))
    return (
        hashed.join(before, name, "left")
        .where(~same)
        .withColumn(stored_hash, F.col("_incoming_hash"))
        .drop("_incoming_hash", "_stored_hash")
    )


def size_matches(content: Column, declared: Column) -> Column:
    """Whether a payload has its declared length in bytes; false when either is missing."""
    return F.coalesce(F.octet_length(content) == declared, F.lit(False))
