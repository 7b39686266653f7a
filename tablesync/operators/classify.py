"""Compare a source with a target by key: the join every sync is built on.

``classify`` gives one row per key with an op (column ``OP``):

* ``insert``    only in the source
* ``update``    in both, some compared column differs (NULL-safe)
* ``unchanged`` in both, nothing differs
* ``keep``      only in the target

The key columns carry plain names; source values keep their names and target
values get a prefix, so any later projection stays prunable.

Both sides must be unique by key. Keys are compared with plain ``=``, which is why
NULL keys are refused beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, UNCHANGED, KEEP, PRUNE = "insert", "update", "unchanged", "keep", "prune"

TARGET_PREFIX = "__t_"
IN_SOURCE = "__in_s"
IN_TARGET = "__in_t"
OP = "__op"


def shared_columns(source: DataFrame, target: DataFrame) -> list[str]:
    """Columns of both sides, in target order."""
    present = set(source.columns)
    return [c for c in target.columns if c in present]


def compared_columns(source: DataFrame, target: DataFrame, key: Sequence[str]) -> list[str]:
    names = [c for c in shared_columns(source, target) if c not in key]
    for name in names:
        if _holds_map(target.schema[name].dataType):
            raise TypeError(f"map values cannot be compared: {name}")
    return names


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def differs(columns: Sequence[str]) -> Column:
    """True when any compared column is distinct, NULL counting as a value."""
    parts = [~F.col(c).eqNullSafe(F.col(TARGET_PREFIX + c)) for c in columns]
    return reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)


def source_side(source: DataFrame, target: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    return source.select(*shared_columns(source, target), *carried, F.lit(True).alias(IN_SOURCE))


def target_side(target: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return target.select(
        *key,
        *[F.col(c).alias(TARGET_PREFIX + c) for c in columns if c not in key],
        F.lit(True).alias(IN_TARGET),
    )


def op_of(compared: Sequence[str]) -> Column:
    return (
        F.when(F.col(IN_TARGET).isNull(), INSERT)
        .when(F.col(IN_SOURCE).isNull(), KEEP)
        .when(differs(compared), UPDATE)
        .otherwise(UNCHANGED)
    )


def classify(
    source: DataFrame, target: DataFrame, key: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Whole source against whole target: one exchange per side.

    ``carried`` names source columns that come along without being compared.
    """
    compared = compared_columns(source, target, key)
    left = source_side(source, target, carried)
    right = target_side(target, key, target.columns)
    return left.join(right, list(key), "full_outer").withColumn(OP, op_of(compared))


def classify_part(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Part of a source (an increment, a stream batch) against the target.

    The inner join goes first: when the part is small it is broadcast at run time
    and the target is read without an exchange; the outer join after it only sees
    the matched rows. Otherwise both joins share the same key partitioning.
    """
    compared = compared_columns(source, target, key)
    left = source_side(source, target)
    matched = target_side(target, key, target.columns).join(
        source.select(*key), list(key), "inner"
    )
    return left.join(matched, list(key), "left").withColumn(OP, op_of(compared))


def merged_columns(
    source: DataFrame, target: DataFrame, key: Sequence[str]
) -> list[Column]:
    """Target row after the merge: source values where the source has the row.

    Columns only the target has keep their value (NULL on an insert).
    """
    shared = set(source.columns)
    row = []
    for name in target.columns:
        if name in key:
            row.append(F.col(name))
        elif name in shared:
            row.append(
                F.when(F.col(IN_SOURCE), F.col(name))
                .otherwise(F.col(TARGET_PREFIX + name))
                .alias(name)
            )
        else:
            row.append(F.col(TARGET_PREFIX + name).alias(name))
    return row


def changed_rows(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of rows present on both sides whose values really differ."""
    compared = compared_columns(source, target, key)
    left = source.select(*key, *compared)
    right = target_side(target, key, compared)
    return left.join(right, list(key), "inner").where(differs(compared)).select(*key)


def op_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(F.col(OP).alias("op")).agg(F.count(F.lit(1)).alias("n"))


def sync_counts(classified: DataFrame, prune: bool) -> DataFrame:
    """read, affected (inserts and real updates) and deleted rows in one pass."""
    op = F.col(OP)
    deleted = F.sum(F.when(op == KEEP, 1).otherwise(0)) if prune else F.lit(0)
    return classified.agg(
        F.sum(F.when(op != KEEP, 1).otherwise(0)).cast("long").alias("read_rows"),
        F.sum(F.when(op.isin(INSERT, UPDATE), 1).otherwise(0)).cast("long").alias("affected_rows"),
        deleted.cast("long").alias("deleted_rows"),
    )
