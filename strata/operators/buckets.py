"""A table kept in buckets of its key, of which an update rewrites only those it touches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import folder_names, small_frame, written

_LIST = "bucket int, folder string"


@dataclass(frozen=True)
class BucketedTable:
    """Rows in ``count`` buckets below ``location``.

    A version is a list of buckets and the folder each lies in. An update writes touched buckets into a new folder
    and then a new list, so readers of an older version are not disturbed, an update that dies leaves nothing but a folder
    nobody reads, and untouched buckets are neither read nor written. ``count`` is fixed for a table's life;
    what reaches the driver is one list of at most so many names. One writer at a time: of two that
    write the same version the second fails.
    """

    spark: SparkSession
    location: str
    keys: tuple[str, ...]
    schema: str
    count: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{key}`") for key in self.keys]), F.lit(self.count)).cast("int")

    def version(self) -> int | None:
        """The newest version whose list is complete."""
        for name in reversed(folder_names(self.spark, f"{self.location}/versions")):
            if "_SUCCESS" in folder_names(self.spark, f"{self.location}/versions/{name}"):
                return int(name)
        return None

    def folders(self, version: int | None = None) -> dict[int, str]:
        version = self.version() if version is None else version
        if version is None:
            return {}
        listed = self.spark.read.schema(_LIST).parquet(f"{self.location}/versions/{version:012d}")
        return {row.bucket: row.folder for row in listed.toLocalIterator()}

    def _read(self, folders: dict[int, str]) -> DataFrame:
        paths = [f"{self.location}/data/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the newest or the given version."""
        return self._read(self.folders(version))

    def read_touched(self, changed: DataFrame, folders: dict[int, str]) -> tuple[list[int], DataFrame]:
        """The buckets that ``changed`` has keys of, and the rows they hold so far."""
        touched = sorted(row.bucket for row in changed.select(self.bucket().alias("bucket")).distinct().toLocalIterator())
        return touched, self._read({bucket: folders[bucket] for bucket in touched if bucket in folders})

    def update(self, number: int, changed: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Make version ``number`` by merging ``changed`` into the buckets it touches; False if it is there already.

        ``merge`` takes the old rows of these buckets and the changed ones and gives their new rows; rows of the
        same key must stay together. Numbers rise, so an update that is repeated after a crash counts once.
        """
        current = self.version()
        if current is not None and number <= current:
            return False
        folders = self.folders(current)
        changed = written(changed, "bucket-changes")  # read twice below; what it is made from only once
        touched, old = self.read_touched(changed, folders)
        if touched:
            folder = uuid.uuid4().hex
            rows = merge(old, changed).select(*old.columns).withColumn("bucket", self.bucket())
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.location}/data/{folder}")
            made = {int(name.removeprefix("bucket=")) for name in folder_names(self.spark, f"{self.location}/data/{folder}") if "=" in name}
            folders = {b: f for b, f in folders.items() if b not in touched} | {b: folder for b in made}
        listed = small_frame(self.spark, sorted(folders.items()), _LIST)
        listed.coalesce(1).write.mode("errorifexists").parquet(f"{self.location}/versions/{number:012d}")
        return True


def replaced(keys: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge in which a changed row takes the place of the old one of its key."""
    def merge(old: DataFrame, changed: DataFrame) -> DataFrame:
        return old.join(changed.select(*keys).distinct(), list(keys), "left_anti").unionByName(changed.select(*old.columns))
    return merge
