"""Several source rows with one key.

One key may hold a large share of all rows, so nothing here gathers a group in one
task: the surviving row is an aggregate (combined before the exchange), and the
row-by-row write count splits the ordered rows by range, not by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.classify import TARGET_PREFIX, compared_columns, target_side
from tablesync.operators.position import POSITION, with_position
from tablesync.session import Scratch


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that several rows have, and how many rows (``n``)."""
    return _counted_repeats(df, key).withColumnRenamed("__n", "n")


def _counted_repeats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return counted.where(F.col("__n") > 1)


def repeated_keys(df: DataFrame, key: Sequence[str], scratch: Scratch) -> DataFrame | None:
    """Keys several rows have, written to the shared folder, or None without any.

    Equal keys have equal hashes, so a wide key is first counted by one long; only
    rows whose hash repeats are counted by the key itself.
    """
    rows = df.select(*key)
    if len(key) > 1 or not isinstance(df.schema[key[0]].dataType, T.IntegralType):
        rows = rows.withColumn("__hash", F.xxhash64(*key))
        suspects = scratch.write(_counted_repeats(rows, ["__hash"]).select("__hash"), "suspects")
        if suspects.isEmpty():
            return None
        rows = rows.join(suspects, "__hash", "left_semi")
    found = scratch.write(_counted_repeats(rows, key).select(*key), "repeated_keys")
    return None if found.isEmpty() else found


def first_two(df: DataFrame, key: Sequence[str], nth: str) -> DataFrame:
    """Two rows of each key at most, numbered in ``nth``: a 2 tells that keys repeat.

    The limit holds on both sides of the exchange, so a hot key sends two rows a task. The
    exchange and the order are those a join by key needs.
    """
    numbered = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    return df.withColumn(nth, numbered).where(F.col(nth) <= 2)


def applied_order(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> list[str]:
    """Columns that order source rows: the declared order, then key, then the rest.

    The rest makes the order total, so equal positions mean equal rows.
    """
    names = [*order_by, *key, *df.columns]
    sortable = [n for n in names if not isinstance(df.schema[n].dataType, T.MapType)]
    return list(dict.fromkeys(sortable))


def dedup(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), keep: str = "last"
) -> DataFrame:
    """One row per key: the last (or first) in source order, NULLs first.

    Rows that ``order_by`` does not tell apart go by their place in the files they come
    from, or else by their values.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    placed = with_position(df)
    if POSITION in placed.columns:
        return _dedup_by_place(placed, key, order_by, keep).select(*df.columns)
    order = [c for c in applied_order(df, key, order_by) if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    if not order:
        return df.dropDuplicates(list(key))
    position = F.struct(*order)
    if rest:  # columns that cannot be compared only travel along
        row = F.struct(*order, *rest)
        pick = F.max_by(row, position) if keep == "last" else F.min_by(row, position)
    else:
        pick = F.max(position) if keep == "last" else F.min(position)
    picked = df.groupBy(*key).agg(pick.alias("__row"))
    return picked.select(
        *[F.col(c) if c in key else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def _dedup_by_place(
    rows: DataFrame, key: Sequence[str], order_by: Sequence[str], keep: str
) -> DataFrame:
    """The place of each key's row is found over key, order and place alone.

    Whole rows only meet the keys that repeat: where these are few, they are broadcast at
    run time and the rows stay where they are.
    """
    order = [*(c for c in order_by if c not in key and c != POSITION), POSITION]
    place = F.struct(*order)
    pick = F.max(place) if keep == "last" else F.min(place)
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), pick.alias("__row"))
    several = counted.where(F.col("__n") > 1).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)],
        F.col("__row").getField(POSITION).alias("__kept"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]
    found = rows.join(several, reduce(lambda a, b: a & b, same), "left")
    return found.where(F.col("__kept").isNull() | (F.col("__kept") == F.col(POSITION)))


def count_writes(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    scratch: Scratch,
) -> DataFrame:
    """Writes when source rows are applied one after another: one row, ``writes``.

    A row counts when it differs from the row before it with the same key; the
    first row of a key is compared with the target row. Ordered rows are cut into
    ranges of (key, order). Inside a range the row before is a plain ``lag``; the
    first row of each range takes the last row of the range before it. Repeats of
    a whole row never count, so they are dropped first and every range can be cut.
    """
    compared = compared_columns(source, target, key)
    order = applied_order(source, key, order_by)
    sort = [*key, *[c for c in order if c not in key]]
    ranged = source.dropDuplicates().repartitionByRange(*sort).sortWithinPartitions(*sort)
    # The id grows with range number and position; written once, it is fixed.
    rows = scratch.write(
        ranged.select(*key, *compared, F.monotonically_increasing_id().alias("__pos")), "steps"
    ).withColumn("__range", F.shiftright("__pos", 33))

    values = F.struct(*key, *compared)
    inside = Window.partitionBy("__range").orderBy("__pos")
    stepped = rows.select("*", F.lag(values).over(inside).alias("__before"))
    # One row per range: bounded by the number of partitions.
    ends = rows.groupBy("__range").agg(F.max_by(values, F.col("__pos")).alias("__end"))
    edges = ends.select(
        "__range", F.lag("__end").over(Window.orderBy("__range")).alias("__edge")
    )
    linked = stepped.join(edges, "__range", "left").withColumn(
        "__before", F.coalesce("__before", "__edge")
    )

    before = F.col("__before")
    same_key = reduce(lambda a, b: a & b, [F.col(k) == before.getField(k) for k in key])
    follows = F.coalesce(same_key, F.lit(False))
    changed = _any_distinct(compared, lambda c: before.getField(c))
    later = linked.where(follows).select(changed.alias("__hit"))
    first = linked.where(~follows).select(*key, *compared)
    known = target_side(target, key, compared)
    against_target = first.join(known, list(key), "left").select(
        (
            F.col("__in_t").isNull()
            | _any_distinct(compared, lambda c: F.col(TARGET_PREFIX + c))
        ).alias("__hit")
    )
    hits = later.unionByName(against_target)
    return hits.agg(F.coalesce(F.sum(F.col("__hit").cast("long")), F.lit(0)).alias("writes"))


def _any_distinct(columns: Sequence[str], other) -> Column:
    parts = [~F.col(c).eqNullSafe(other(c)) for c in columns]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)
