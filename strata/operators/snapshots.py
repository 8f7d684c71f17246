"""Snapshots of JSON bodies: newest one, payload checks, flattening."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, fetched: str = "fetched_at_utc", partition: str | None = None,
                    unit: str | None = None, newest_partition: str | None = None) -> DataFrame:
    """All rows of the newest snapshot, whatever they hold; no fallback to an older one.

    The maximum is a scalar subquery over one column, which Spark also hands to the
    parquet reader; bodies are neither shuffled nor gathered. With ``partition`` (a
    column that rises with ``fetched``) only the last folder's rows are read, though finding that
    folder opens the footers of all; whoever knows the last folder, as an ingest that kept its high-water mark does,
    names it by ``newest_partition``, and then no other folder's files are opened. With ``unit`` a snapshot is all that was fetched in the newest
    day, hour and so on: a bound on the stored time, so the scan skips what is older.
    """
    if partition and newest_partition is not None:
        df = df.where(F.col(partition) == newest_partition)
    elif partition:
        df = df.where(F.col(partition) == df.agg(F.max(partition)).scalar())
    newest = df.agg(F.max(fetched).alias("newest"))
    if unit is None:
        return df.where(F.col(fetched) == newest.scalar())
    start = newest.select(F.date_trunc(unit, "newest").cast(df.schema[fetched].dataType))
    return df.where(F.col(fetched) >= start.scalar())


def newest_row(df: DataFrame, fetched: str, tie_breaker: str) -> DataFrame:
    """The single newest row; the tie breaker makes the choice repeatable."""
    return df.orderBy(F.col(fetched).desc(), F.col(tie_breaker).desc()).limit(1)


def is_json(body: Column) -> Column:
    """Whether a body is one well-formed JSON document (NULL is not)."""
    return F.try_parse_json(body).isNotNull()


def parse_payload(df: DataFrame, schema: str, body: str = "raw_json", records: str = "data",
                  into: str = "_records") -> DataFrame:
    """Add the body's record list, NULL for a broken body; flags and rows are then taken from it."""
    return df.withColumn(into, F.from_json(F.col(body), schema).getField(records))


def flag_parsed(df: DataFrame, parsed: str = "_records") -> DataFrame:
    """Add ``payload_schema_valid`` and ``population_data_not_empty`` from the parsed list.

    The second flag is NULL, not false, when there is no list at all.
    """
    found = F.col(parsed)
    return df.withColumns(
        {"payload_schema_valid": found.isNotNull(), "population_data_not_empty": F.array_size(found) > 0}
    )


def flag_payload(df: DataFrame, schema: str, body: str = "raw_json", records: str = "data") -> DataFrame:
    """The two flags beside the raw body."""
    return flag_parsed(parse_payload(df, schema, body, records)).drop("_records")


def explode_parsed(df: DataFrame, parsed: str = "_records", record: str = "_record", keep_empty: bool = True) -> DataFrame:
    """One row per record of the parsed list, with the snapshot's other columns.

    ``keep_empty`` gives a snapshot without records one row with a NULL record, which
    the not-null rules behind it then report; otherwise it gives none.
    """
    found = F.col(parsed)
    return df.withColumn(record, F.explode_outer(found) if keep_empty else F.explode(found)).drop(parsed)


def explode_records(df: DataFrame, schema: str, body: str = "raw_json", records: str = "data",
                    record: str = "_record", keep_empty: bool = True) -> DataFrame:
    """The records of raw bodies as rows, see :func:`explode_parsed`."""
    return explode_parsed(parse_payload(df, schema, body, records), record=record, keep_empty=keep_empty).drop(body)


def explode_list(df: DataFrame, element: str, body: str = "raw_json", path: str = "$.data",
                 record: str = "_record") -> DataFrame:
    """One row per element of the list at a JSON path; nothing for a missing list."""
    listed = F.from_json(F.get_json_object(F.col(body), path), f"array<{element}>")
    return df.withColumn(record, F.explode(listed)).drop(body)


def record_fields(names: Mapping[str, str], record: str = "_record") -> list[Column]:
    """Record fields under new names; field names may hold spaces."""
    return [F.col(record).getField(field).alias(target) for field, target in names.items()]
