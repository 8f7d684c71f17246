"""Whole folders of delimited text: any number of files, each with its own header, in a fixed number of jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import is_present
from strata.operators.contracts import KEY_FLAG, SCHEMA_FLAG, Contract
from strata.session import scratch_path, written

#: Rows of a task, the lower part of its generated ids.
_ROW_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Landed:
    """Lines of a folder as they were at one moment, and the header of every file.

    ``lines``: path, file_name, dataset, line. ``headers``: path, file_name, dataset, names.
    """

    lines: DataFrame
    headers: DataFrame
    separator: str


def land_lines(spark: SparkSession, folder: str, dataset: Callable[[Column, Column], Column], ignored: Sequence[str] = (),
               separator: str = "\t", recursive: bool = False) -> Landed:
    """Read every file of ``folder`` once and keep its lines apart from its header.

    ``dataset`` names a file's dataset from its name and path. The scan is planned with one split of one file per
    task, so the first line that is not blank of the task that has a file's first block is the file's header: no
    job per file, no sort, no second look at the text. Files are read once, so header and
    rows are of the same version even if somebody replaces the file. A file without lines has no header and no rows.
    """
    reader = spark.newSession()  # the setting is for this scan only
    reader.conf.set("spark.sql.files.openCostInBytes", reader.conf.get("spark.sql.files.maxPartitionBytes"))
    name, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    text = reader.read.option("recursiveFileLookup", str(recursive).lower()).text(folder)
    if ignored:
        text = text.where(~name.isin(*ignored))
    placed = text.where(F.trim(F.regexp_replace("value", r"\s", " ")) != "").select(
        path.alias("path"), name.alias("file_name"), dataset(name, path).alias("dataset"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    first = (F.col("_block") == 0) & (F.col("_row").bitwiseAND(F.lit(_ROW_BITS)) == 0)
    kept = placed.select("path", "file_name", "dataset", "line", first.cast("int").alias("is_header"))
    target = scratch_path(spark, "folder-lines")
    kept.write.partitionBy("is_header").parquet(target)
    stored = spark.read.schema("path string, file_name string, dataset string, line string, is_header int").parquet(target)
    names = F.transform(F.split("line", f"\\Q{separator}\\E"), lambda n: F.lower(F.trim(n)))
    headers = written(stored.where("is_header = 1").select("path", "file_name", "dataset", names.alias("names")), "folder-headers")
    landed = Landed(stored.where("is_header = 0").drop("is_header"), headers, separator)
    check_headers(landed)
    return landed


def check_headers(landed: Landed) -> None:
    """Raise if any file with rows has not exactly one header: the scan was not planned as :func:`land_lines` needs it."""
    counted = landed.headers.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    paths = landed.lines.select("path").distinct()
    wrong = paths.join(counted, "path", "full_outer").where("n IS NULL OR n <> 1").head(3)
    if wrong:
        raise ValueError(f"no single header in {', '.join(row.path for row in wrong)}")


def dataset_columns(headers: DataFrame) -> DataFrame:
    """``dataset, names``: the columns of a dataset in the order of its headers, those of the first file first.

    One row per dataset, that is, per table somebody will look up by name; not per file.
    """
    layouts = headers.groupBy("dataset", "names").agg(F.min("path").alias("_first"))
    merged = layouts.groupBy("dataset").agg(F.sort_array(F.collect_list(F.struct("_first", "names"))).alias("_layouts"))
    return merged.select("dataset", F.array_distinct(F.flatten(F.col("_layouts.names"))).alias("names"))


def all_columns(headers: DataFrame) -> list[str]:
    """Different column names of all files: the width of a table, whatever the number of files."""
    found = headers.select(F.explode("names").alias("name")).distinct().orderBy("name")
    return [row.name for row in found.toLocalIterator()]


def by_header(landed: Landed, contracts: Mapping[str, Contract] | None = None) -> DataFrame:
    """One row per line, its values under the names of its own file's header; names a file lacks are NULL.

    Columns: dataset, every name of any file, lineage, and with ``contracts`` (by file name) the two layout flags. What
    headers say is written, a row per file, and joined as its size has it: broadcast while small, else by path, where
    AQE splits the partition of a very large file. Of names that repeat in a header the first counts.
    """
    names = all_columns(landed.headers)
    positions = F.transform(F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>"),
                            lambda n: F.array_position("names", n).cast("int") - 1)
    known = landed.headers.select("path", positions.alias("_at"), F.size("names").alias("_width"), "file_name", "names")
    spark = landed.headers.sparkSession
    rules = spark.createDataFrame([(f, list(c.columns), list(c.keys)) for f, c in (contracts or {}).items()],
                                  "file_name string, _columns array<string>, _keys array<string>")
    known = written(known.join(rules, "file_name", "left").select(
        "path", "_at", F.coalesce(F.col("names") == F.col("_columns"), F.lit(False)).alias(SCHEMA_FLAG),
        F.transform("_keys", lambda key: F.array_position("names", key).cast("int") - 1).alias("_key_at")), "folder-positions")
    width = landed.headers.agg(F.max(F.size("names"))).first()[0] or 1
    fields = ", ".join(f"c{i} string" for i in range(width))
    options = {"sep": landed.separator, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    joined = landed.lines.join(known, "path").withColumn("_row", F.from_csv("line", fields, options))
    values = F.array(*[F.col(f"_row.c{i}") for i in range(width)])
    filled = F.forall("_key_at", lambda at: (at >= 0) & is_present(F.get("_values", at)))
    return joined.withColumn("_values", values).select(
        "dataset", *[F.get("_values", F.get("_at", F.lit(i))).alias(n) for i, n in enumerate(names)],
        SCHEMA_FLAG, F.coalesce(filled, F.lit(False)).alias(KEY_FLAG),
        F.col("file_name").alias("_source_file"), F.col("path").alias("_source_path"), F.current_timestamp().alias("_bronze_refreshed_at_utc"))
