"""Typing of raw text by a declared mapping, one specification per dataset."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import Expectation, flag_unique_key

LINEAGE = ("_source_file", "_source_path", "_bronze_refreshed_at_utc")
UNIQUE_FLAG = "_natural_key_unique"


@dataclass(frozen=True)
class Field:
    source: str
    target: str
    type: str = "string"


@dataclass(frozen=True)
class ConformSpec:
    """How one raw dataset becomes one typed dataset."""

    source: str
    target: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    required: tuple[str, ...]
    comment: str = ""
    keep: tuple[str, ...] = field(default=LINEAGE)

    @classmethod
    def of(cls, source: str, target: str, fields: str, keys: str, required: str = "", comment: str = "",
           keep: tuple[str, ...] = LINEAGE) -> ConformSpec:
        """Short form: ``"code level:int seasonal>seasonal_code"`` as ``source[>target][:type]``."""
        parsed = []
        for item in fields.split():
            names, _, type_name = item.partition(":")
            source_name, _, target_name = names.partition(">")
            parsed.append(Field(source_name, target_name or source_name, type_name or "string"))
        return cls(source, target, tuple(parsed), tuple(keys.split()), tuple((required or keys).split()),
                   comment, keep)


def conform(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Trim, convert, rename and select; a value that does not convert becomes NULL."""
    typed = [F.trim(F.col(f"`{f.source}`")).try_cast(f.type).alias(f.target) for f in spec.fields]
    carried = [F.col(name) for name in spec.keep if name in df.columns]
    return df.select(*typed, *carried)


def conform_checked(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """:func:`conform` plus the flag that marks rows sharing their natural key."""
    return flag_unique_key(conform(df, spec), spec.keys, UNIQUE_FLAG)


def conform_rules(spec: ConformSpec) -> list[Expectation]:
    """Failing rules of a typed dataset: required columns filled and the key unique."""
    filled = [Expectation(f"{name}_not_null", f"`{name}` IS NOT NULL", "fail") for name in spec.required]
    return [*filled, Expectation("unique_natural_key", UNIQUE_FLAG, "fail")]


def conform_all(read: Callable[[str], DataFrame], specs: Iterable[ConformSpec]) -> Mapping[str, DataFrame]:
    """One typed dataset per specification, keyed by its target name."""
    return {spec.target: conform_checked(read(spec.source), spec) for spec in specs}
