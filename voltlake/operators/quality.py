"""Data-quality checks. Every check is an aggregate: one small row per rule comes back."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class QualityRule:
    """A row predicate, as a SQL expression, that must hold for ``all`` rows or ``any`` row."""

    name: str
    predicate: str
    how: str = "all"

    def __post_init__(self):
        if self.how not in ("all", "any"):
            raise ValueError(f"how must be 'all' or 'any', not {self.how!r}")


class QualityError(ValueError):
    """A rule did not hold."""


def not_empty(table: str) -> QualityRule:
    return QualityRule(f"row_count_{table}", "true")


def has_length(name: str, column: str, length: int) -> QualityRule:
    return QualityRule(name, f"length({column}) = {length}")


def in_open_range(name: str, column: str, low: float, high: float) -> QualityRule:
    return QualityRule(name, f"{column} > {low} and {column} < {high}")


def evaluate(df: DataFrame, rules: list[QualityRule]) -> DataFrame:
    """rule, n_rows, n_passed, passed for all rules in one pass.

    A null predicate counts as false, and a table without rows fails every rule.
    """
    return df.agg(_results(rules).alias("results")).select(F.inline("results"))


def _results(rules: list[QualityRule]) -> Column:
    """Array of struct<rule, n_rows, n_passed, passed>, as one aggregate."""
    n_rows = F.count(F.lit(1))
    results = []
    for rule in rules:
        n_passed = F.count_if(F.coalesce(F.expr(rule.predicate), F.lit(False)))
        held = n_passed == n_rows if rule.how == "all" else n_passed > 0
        results.append(
            F.struct(
                F.lit(rule.name).alias("rule"),
                n_rows.alias("n_rows"),
                n_passed.alias("n_passed"),
                ((n_rows > 0) & held).alias("passed"),
            )
        )
    return F.array(*results)


def require(df: DataFrame, rules: list[QualityRule], table: str) -> None:
    """Raises on the first failed rule."""
    if not rules:
        return
    _raise_failed(evaluate(df, rules).collect(), table)  # one row per rule


def watched(df: DataFrame, rules: list[QualityRule], table: str) -> tuple[DataFrame, Callable[[], None]]:
    """The same rows, and a check to be called after they were written: the rules are counted
    while the write runs, with no pass of their own."""
    if not rules:
        return df, lambda: None
    seen = Observation()
    return df.observe(seen, _results(rules).alias("results")), lambda: _raise_failed(seen.get["results"], table)


def _raise_failed(results: list[Row], table: str) -> None:
    for row in results:
        if not row["passed"]:
            raise QualityError(
                f"{table}: rule {row['rule']!r} failed, {row['n_passed']} of {row['n_rows']} rows"
            )


def require_references(tables: Mapping[str, DataFrame], references: list[tuple[str, str, str, str]]) -> None:
    """Raises if a child refers to a parent that isn't there; references as in ``schemas``."""
    for child, column, parent, parent_column in references:
        lost = orphans(tables[child], column, tables[parent], parent_column, {}).first()
        if lost["n_orphan_rows"]:
            raise QualityError(f"{child}.{column}: {lost['n_orphan_rows']} rows without {parent}")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def count_nulls(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """table_name, column_name, n_null for every NOT NULL column."""
    counts = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.count_if(F.col(f.name).isNull()).alias("n_null"),
        )
        for f in schema
        if not f.nullable
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def key_uniqueness(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """table_name, n_rows, n_keys, n_repeated_keys.

    Only the key columns are read, and equal keys merge before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
    )


def require_unique(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """The same DataFrame, after checking that ``keys`` repeat nowhere."""
    repeated = key_uniqueness(df, keys, table).first()["n_repeated_keys"]
    if repeated:
        raise QualityError(f"{table}: {repeated} values of {keys} occur more than once")
    return df


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: dict[str, str]
) -> DataFrame:
    """References without a parent: *label, n_orphan_keys, n_orphan_rows.

    The child is counted per key before the anti join, so a key holding a third of the rows
    reaches the join as one row per task at most. Null references are no orphans.
    """
    per_key = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("key"))
    lost = per_key.join(known, "key", "left_anti")
    return lost.agg(
        *[F.lit(v).alias(k) for k, v in label.items()],
        F.count(F.lit(1)).alias("n_orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphan_rows"),
    )


def with_shape(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows while another action runs; read ``observation.get`` afterwards."""
    seen = Observation(name)
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(F.lit(len(df.columns))).alias("columns")
    )
    return observed, seen
