"""Named queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    oracle: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is its SQL over the plain tables, if SQL can say it."""
    def register(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Registered(run, oracle)
        return run
    return register


def with_parts(select: str, *parts: str) -> str:
    """A statement from named common table expressions and a final select."""
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + select.strip()
