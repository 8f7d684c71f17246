"""Expectations: named row predicates that warn about or stop a dataset."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import written

WARN, FAIL = "warn", "fail"


@dataclass(frozen=True)
class Expectation:
    """``predicate`` should hold for every row; a NULL outcome counts as a violation."""

    name: str
    predicate: str
    mode: str = WARN

    def __post_init__(self) -> None:
        if self.mode not in (WARN, FAIL):
            raise ValueError(f"unknown mode {self.mode!r} of expectation {self.name!r}")

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def expect_all(rules: Mapping[str, str], mode: str = WARN) -> list[Expectation]:
    return [Expectation(name, predicate, mode) for name, predicate in rules.items()]


@dataclass(frozen=True)
class RuleOutcome:
    name: str
    mode: str
    checked: int
    violations: int


class GateError(RuntimeError):
    """Raised when a failing expectation is violated; carries every rule's counts."""

    def __init__(self, dataset: str, outcomes: Sequence[RuleOutcome]) -> None:
        self.outcomes = list(outcomes)
        broken = ", ".join(f"{o.name}={o.violations}" for o in outcomes if o.mode == FAIL and o.violations)
        super().__init__(f"{dataset} not published, violated: {broken}")


def violation_counts(rules: Iterable[Expectation]) -> list[Column]:
    """Aggregates for one pass: the row count, then one violation count per rule."""
    counts = [F.count_if(rule.violated()).alias(rule.name) for rule in rules]
    return [F.count(F.lit(1)).alias("_checked"), *counts]


def outcomes_of(rules: Iterable[Expectation], metrics: Mapping[str, int]) -> list[RuleOutcome]:
    return [RuleOutcome(r.name, r.mode, metrics["_checked"], metrics[r.name]) for r in rules]


def expect_report(df: DataFrame, rules: Sequence[Expectation], by: str | None = None) -> DataFrame:
    """One row per rule (and value of ``by``): ``rule, mode, checked, violations``; ``df`` is scanned once."""
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.mode).alias("mode"),
            F.col("_checked").alias("checked"),
            F.col(f"`{rule.name}`").alias("violations"),
        )
        for rule in rules
    ]
    if by:
        return df.groupBy(by).agg(*violation_counts(rules)).select(by, F.inline(F.array(*rows)))
    return df.agg(*violation_counts(rules)).select(F.inline(F.array(*rows)))


def flag_violations(df: DataFrame, rules: Sequence[Expectation], column: str = "_violated") -> DataFrame:
    """Add the names of the rules each row violates (an empty array for a clean row)."""
    names = [F.when(rule.violated(), F.lit(rule.name)) for rule in rules]
    return df.withColumn(column, F.array_compact(F.array(*names)))


def expect_rows(df: DataFrame, rules: Sequence[Expectation], column: str = "_violated") -> DataFrame:
    """The rows that violate at least one rule, with the names of the rules."""
    return flag_violations(df, rules, column).where(F.size(column) > 0)


def enforce(df: DataFrame, rules: Sequence[Expectation], carrier: str) -> DataFrame:
    """Make a write of ``df`` stop at the first row violating a failing rule.

    The check is tied to ``carrier``, a column the sink stores, so it cannot be pruned.
    Meant directly before a sink: a filter applied to the result afterwards may be
    evaluated first and hide rows from the check.
    """
    for rule in rules:
        if rule.mode == FAIL:
            stop = F.raise_error(F.lit(f"expectation violated: {rule.name}"))
            df = df.withColumn(carrier, F.when(rule.violated(), stop).otherwise(F.col(carrier)))
    return df


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often, counted before and after the shuffle."""
    counted = df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where("occurrences > 1")


def flag_unique_key(df: DataFrame, keys: Sequence[str], flag: str = "_natural_key_unique") -> DataFrame:
    """Mark each row whose key (NULLs compared as equal) no other row has; keep all rows.

    Only keys are shuffled, after a partial count per task. The duplicated ones are
    written out, so the planner knows their size: the usual few are broadcast and the
    rows stay where they are; a large set is joined by key, where a key holding a big
    share of the rows is split by AQE (a window over the key could not be). This runs a job over the
    keys when called and reads ``df`` again later: hand it data that does not move in between, such as a
    version that was published or written, not a folder others add to.
    """
    renamed = [F.col(f"`{key}`").alias(f"_dup_{i}") for i, key in enumerate(keys)]
    repeats = written(duplicated_keys(df, keys).select(*renamed, F.lit(True).alias("_dup")), "duplicated-keys")
    same_key = reduce(
        Column.__and__, [F.col(f"`{key}`").eqNullSafe(F.col(f"_dup_{i}")) for i, key in enumerate(keys)]
    )
    return (
        df.join(repeats, same_key, "left")
        .withColumn(flag, F.col("_dup").isNull())
        .drop("_dup", *[f"_dup_{i}" for i in range(len(keys))])
    )
