"""Constraint checks that run before anything is published.

Spark does not enforce keys, so each check is a DataFrame of offending rows; a run
with a non-empty check publishes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.classify import INSERT, OP, UPDATE
from tablesync.operators.duplicates import applied_order
from tablesync.operators.position import POSITION


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def null_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.where(any_null(key))


def rekeyed_pairs(
    source: DataFrame, target: DataFrame, key: Sequence[str], unique: Sequence[str]
) -> DataFrame:
    """Source rows whose unique value a target row with another key already holds.

    Such a row cannot be inserted unless prune removes the old row first. The
    target is unique by ``unique``, so a source row meets at most one target row.
    """
    old = target.select(*unique, *[F.col(k).alias(f"target_{k}") for k in key])
    pairs = source.select(*unique, *[F.col(k).alias(f"source_{k}") for k in key]).join(
        old, list(unique), "inner"
    )
    return pairs.where(_keys_differ(key, "source_", "target_"))


def _keys_differ(key: Sequence[str], left: str, right: str) -> Column:
    parts = [~F.col(left + k).eqNullSafe(F.col(right + k)) for k in key]
    return reduce(lambda a, b: a | b, parts)


def unique_violations(
    target: DataFrame, changes: DataFrame, key: Sequence[str], unique: Sequence[str]
) -> DataFrame:
    """Rows which share a unique value once the change set is applied.

    Only written rows can bring a new clash, so untouched target rows take part
    only when they hold a written value. Reads just the key and unique columns.
    """
    columns = list(dict.fromkeys([*key, *unique]))
    held = ~any_null(unique)
    written = changes.where(F.col(OP).isin(INSERT, UPDATE)).select(*columns).where(held)
    values = written.select(*unique).distinct()
    untouched = (
        target.select(*columns)
        .where(held)
        .join(values, list(unique), "left_semi")
        .join(changes.select(*key), list(key), "left_anti")
    )
    after = untouched.unionByName(written)
    clashing = after.groupBy(*unique).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return after.join(clashing.select(*unique), list(unique), "left_semi")


def row_ranges(rows: DataFrame, values: DataFrame, unique: Sequence[str]) -> DataFrame:
    """(unique columns, first_row, last_row): the places of the rows that hold some values.

    ``rows`` are source rows with their place in the files they come from.
    """
    held = rows.join(values.select(*unique).distinct(), list(unique), "left_semi")
    return held.groupBy(*unique).agg(
        F.min(POSITION).alias("first_row"), F.max(POSITION).alias("last_row")
    )


def repeated_values(rows: DataFrame, unique: Sequence[str]) -> DataFrame:
    """Unique values held more than once in a whole table."""
    held = rows.where(~any_null(unique))
    counted = held.groupBy(*unique).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.col("__n") > 1).select(*unique)


def unique_violations_in_order(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    unique: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Source rows that fail when rows are applied one by one and checked each time.

    A source row fails if an earlier source row has its unique value, or if a
    target row with another key has it and no earlier source row moved that target
    row away. Keys are unique on both sides. Stricter than the end state: swapping
    two unique values fails here. Pass the target as it is after prune.
    """
    order = [c for c in applied_order(source, key, order_by) if c in (*order_by, *key)]
    position = F.struct(*order)
    columns = list(dict.fromkeys([*key, *unique]))
    rows = source.where(~any_null(unique)).select(*columns, position.alias("__pos"))

    first = rows.groupBy(*unique).agg(F.min("__pos").alias("__first"))
    late = rows.join(first, list(unique), "inner").where(F.col("__pos") > F.col("__first"))

    holders = target.select(*unique, *[F.col(k).alias(f"__h_{k}") for k in key])
    moved = source.select(
        *[F.col(k).alias(f"__h_{k}") for k in key], position.alias("__moved")
    )
    blocked = (
        rows.join(holders, list(unique), "inner")
        .where(_keys_differ(key, "", "__h_"))
        .join(moved, [f"__h_{k}" for k in key], "left")
        .where(F.col("__moved").isNull() | (F.col("__moved") > F.col("__pos")))
    )
    return late.select(*columns).unionByName(blocked.select(*columns)).distinct()
