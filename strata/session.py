"""Sessions, the shared scratch folder and written intermediates."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    AQE sizes shuffle partitions, turns joins into broadcasts from measured sizes
    and splits skewed join partitions, so it is the one setting not to switch off.
    On a cluster pass a large ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``
    and let AQE merge what turns out small.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private temporary folder is made only for a local master, where driver and
    executors share one disk; on a cluster the setting is required, because data
    on one machine's disk would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="strata-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, so no run sees another run's files."""
    return f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def has_path(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there; nothing is opened."""
    place, files = _place(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a frame that needs no Python worker."""
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, kinds)], schema=kinds))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner
    real file sizes: a small result is then broadcast by Spark's own size check and
    a large one is not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
