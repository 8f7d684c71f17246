"""Publishing a dataset: write it once, check it on the way, switch readers over."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from strata.operators.quality import FAIL, Expectation, GateError, RuleOutcome, outcomes_of, violation_counts
from strata.operators.quality_log import record

VERSION = "strata.version"


@dataclass(frozen=True)
class Published:
    data: DataFrame
    path: str
    outcomes: list[RuleOutcome]
    query: str

    @property
    def warnings(self) -> list[RuleOutcome]:
        return [o for o in self.outcomes if o.violations and o.mode != FAIL]


def publish(
    df: DataFrame,
    location: str,
    rules: Sequence[Expectation] = (),
    view: str | None = None,
    comment: str = "",
    partition_by: Sequence[str] = (),
    temporary: bool = False,
    log: str | None = None,
) -> Published:
    """Write ``df`` as a new version below ``location`` and point ``view`` at it.

    The rules are counted by an observation on the last node before the sink, so the
    check costs no second scan and sees exactly the rows that were written. A violated
    failing rule raises :class:`GateError` and leaves the view on its old version.
    No file is moved: switching is one catalog change, so readers see one version or
    the other, also on an object store, and a job that dies leaves no trace in the view.
    Every version has a folder of its own, so neither another publisher nor a later one touches what a
    reader of an older version still needs; :func:`remove_versions` removes old ones when it is asked to.
    With ``log`` the outcomes of every version, also of one that is refused, are added to that log before
    readers see it.
    """
    spark = df.sparkSession
    lasting = view if view and not temporary else None
    path = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, *violation_counts(rules)).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

    counted = seen.get
    outcomes = outcomes_of(rules, counted)
    if log:
        record(spark, log, view or location, path.rsplit("/", 1)[-1], outcomes)
    if any(o.mode == FAIL and o.violations for o in outcomes):
        raise GateError(view or location, outcomes)

    stored = stored_query(df, path, no_files=bool(partition_by) and counted["_checked"] == 0)
    data = spark.sql(stored)
    if lasting:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} COMMENT '{text}' TBLPROPERTIES ('{VERSION}' = '{path}') AS {stored}"
        )
    elif view:
        data.createOrReplaceTempView(view)
    return Published(data, path, outcomes, stored)


def remove_versions(spark: SparkSession, location: str, view: str, older_than: datetime) -> list[str]:
    """Delete versions below ``location`` last written before ``older_than``, but for the one ``view`` reads.

    The age is the caller's promise that no reader of those versions is left.
    """
    current = spark.sql(f"SHOW TBLPROPERTIES {view} ('{VERSION}')").first().value
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(location)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = older_than.timestamp() * 1000
    removed = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        if entry.isDirectory() and name != current.rstrip("/").rsplit("/", 1)[-1] and entry.getModificationTime() < limit:
            files.delete(entry.getPath(), True)
            removed.append(name)
    return removed


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def stored_query(df: DataFrame, path: str, no_files: bool) -> str:
    """Query of written data; one without any file takes the columns from the frame instead."""
    if no_files:
        types = df.sparkSession._jvm.org.apache.spark.sql.types.DataType
        columns = ", ".join(f"CAST(NULL AS {types.fromJson(f.dataType.json()).sql()}) AS {quoted(f.name)}" for f in df.schema)
        return f"SELECT {columns} WHERE false"
    return f"SELECT * FROM parquet.`{path}`"


def gated_view(df: DataFrame, location: str, rules: Sequence[Expectation], view: str, log: str | None = None) -> Published:
    """A checked intermediate for this session only, read by name."""
    return publish(df, location, rules, view, temporary=True, log=log)


def append_snapshot(df: DataFrame, location: str, snapshot: str, again: bool = False) -> str:
    """Land one immutable snapshot in a folder of its own; landing it twice is an error.

    With ``again`` a rerun replaces what an earlier attempt of the same snapshot left.
    """
    path = f"{location.rstrip('/')}/{snapshot}"
    df.write.mode("overwrite" if again else "errorifexists").parquet(path)
    return path


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a log that is never rewritten."""
    df.write.mode("append").parquet(path)
