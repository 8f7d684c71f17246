"""Column expressions over text: blank tests, physical names, table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_present(value: Column) -> Column:
    """True for a value that is neither NULL nor only spaces; never NULL itself."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def normalize_name(name: Column, prefix: str = "") -> Column:
    """A name safe for a catalog: lower case, other runs as one underscore, no edge ones."""
    squeezed = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.concat(F.lit(prefix), F.regexp_replace(squeezed, "^_|_$", ""))


def plain_number(value: Column) -> Column:
    """A double without exponent where its size allows: ``322069808.0``, not ``3.22069808E8``."""
    text = value.cast("string")
    size = F.abs(value)
    large = F.regexp_replace(text.try_cast("decimal(38,12)").cast("string"), r"(\.\d+?)0+$", "$1")
    small = F.regexp_replace(text.try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    return (
        F.when((size >= 1e7) & (size < 1e16), large)
        .when((size >= 1e-4) & (size < 1e-3), small)
        .otherwise(text)
    )


def table_cell(value: Column, kind: T.DataType = T.StringType()) -> Column:
    """Text of one cell of a pipe table: NULL is empty, separators and breaks are escaped."""
    if isinstance(kind, T.BooleanType):
        text = F.initcap(value.cast("string"))
    elif isinstance(kind, T.DoubleType):
        text = plain_number(value)
    else:
        text = value.cast("string")
    text = F.coalesce(text, F.lit(""))
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.regexp_replace(text, "\r\n|\n|\r", "<br>")


def table_row(schema: T.StructType) -> Column:
    """One pipe-table line from the columns of ``schema``."""
    cells = F.concat_ws(" | ", *[table_cell(F.col(f"`{f.name}`"), f.dataType) for f in schema])
    return F.concat(F.lit("| "), cells, F.lit(" |"))
