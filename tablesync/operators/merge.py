"""Upsert and mirror: the target after a sync, and the rows a sync has to write."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.classify import (
    INSERT,
    KEEP,
    OP,
    PRUNE,
    TARGET_PREFIX,
    UPDATE,
    classify,
    classify_part,
    merged_columns,
)
from tablesync.operators.prune import dealt_keys, prune_keys


def upsert(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert missing rows, update differing rows, leave the rest as it is.

    A table that is all key has nothing to update: known keys are ignored.
    """
    return classify(source, target, key).select(*merged_columns(source, target, key))


def mirror(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Prune and upsert as one result: rows whose key left the source are gone."""
    rows = classify(source, target, key).where(F.col(OP) != KEEP)
    return rows.select(*merged_columns(source, target, key))


def upsert_keys(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert of a table that is all key: target rows and the keys it lacks."""
    new = source.select(*key).distinct().join(dealt_keys(target, key), list(key), "left_anti")
    return target.select(*key).unionByName(new)


def change_set(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    prune: bool = False,
    all_keys: DataFrame | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Only the rows to write: their op (column ``OP``) plus the full target row.

    ``source`` is the whole source unless ``all_keys`` is given; then it is a part
    of it and ``all_keys`` holds the keys of the whole source, which prune needs.
    ``watch`` sees all rows of a whole comparison, with the ``carried`` source columns.
    """
    if all_keys is None:
        wanted = (INSERT, UPDATE, KEEP) if prune else (INSERT, UPDATE)
        rows = classify(source, target, key, carried)
        rows = (watch(rows) if watch else rows).where(F.col(OP).isin(*wanted))
        op = F.when(F.col(OP) == KEEP, PRUNE).otherwise(F.col(OP)).alias(OP)
        return rows.select(op, *merged_columns(source, target, key))
    rows = classify_part(source, target, key).where(F.col(OP).isin(INSERT, UPDATE))
    changes = rows.select(OP, *merged_columns(source, target, key))
    if prune:
        changes = changes.unionByName(pruned_rows(target, all_keys, key))
    return changes


def pruned_rows(target: DataFrame, all_keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Prune part of a change set; only the key of a removed row matters."""
    removed = prune_keys(target, all_keys, key)
    return removed.select(
        F.lit(PRUNE).alias(OP),
        *[
            F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema
        ],
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Target with a change set applied, in one exchange per side.

    ``partitions`` fixes the key partitioning of the result, so a writer that lays
    files out by the same hash needs no exchange of its own.
    """
    if partitions:
        target = target.repartition(partitions, *key)
        changes = changes.repartition(partitions, *key)
    old = target.select(*key, *[F.col(c).alias(TARGET_PREFIX + c) for c in target.columns if c not in key])
    joined = old.join(changes, list(key), "full_outer")
    kept = F.col(OP).isNull() | (F.col(OP) != PRUNE)
    return joined.where(kept).select(
        *[
            F.col(c)
            if c in key
            else F.when(F.col(OP).isNull(), F.col(TARGET_PREFIX + c)).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
