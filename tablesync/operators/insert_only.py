"""Insert-only load: skip any row that clashes on the key or on any unique key.

Rows count in source order: a row is accepted unless an accepted earlier row or a
target row holds one of its keys. A skipped row blocks nobody. NULL never clashes.

With one key this is an anti-join against the target and a de-duplication. With several,
whole rows move once:

1. the source is sorted and written with its positions;
2. for each key, its values and positions alone meet the values of the target. What comes
   out is one table of incidences, a group (a key and one of its values) and a position
   each, whatever the number and types of the keys; rows of a value that the target holds
   go, and values that one row has leave no trace;
3. rounds of one aggregate by group and one by position settle the rest: rows that come
   first in all their groups win, and the rows of a group with a winner go;
4. the positions that went become bitmaps, which the written rows are read against.

A row depends on the undecided rows before it in its groups. Where a round decides only a
few, single dependencies are followed too: they form trees, which pointer doubling settles
whole, so a chain of any length takes a logarithmic number of joins.

The first undecided row of all always wins, so rounds end. No row is dropped or capped.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.constraints import any_null
from tablesync.operators.duplicates import applied_order, dedup
from tablesync.session import Scratch

log = logging.getLogger(__name__)

SALTS = 1024


def all_keys(key: Sequence[str], unique_keys: Sequence[Sequence[str]]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys([tuple(key), *(tuple(u) for u in unique_keys)]))


def without_clash(
    rows: DataFrame, taken: DataFrame, columns: Sequence[str], narrow: bool = False
) -> DataFrame:
    """Rows whose key value is not in ``taken``; rows with a NULL in it stay.

    NULL values match nothing but would all hash to one task, so they are spread
    with a salt that equals zero for every other row. ``taken`` is unique by these
    columns, apart from NULLs, which it does not send.

    An anti join cannot broadcast its left side, so a few rows against a large table
    would shuffle the table. With ``narrow`` the table is first cut to the values
    the rows have, a join in which the few values can be broadcast at run time.
    """
    if narrow:
        values = rows.select(*columns).distinct()
        taken = taken.select(*columns).join(values, list(columns), "left_semi")
    left = rows.withColumn("__salt", _salt(rows, columns))
    return left.join(_unsalted(taken, columns), [*columns, "__salt"], "left_anti").select(*rows.columns)


def _salt(rows: DataFrame, columns: Sequence[str]) -> Column:
    """Zero, or a number that spreads rows with a NULL among these columns."""
    spread = F.lit(1) + F.pmod(F.xxhash64(*_hashable(rows)), F.lit(SALTS))
    return F.when(any_null(columns), spread).otherwise(F.lit(0)).cast("long")


def _unsalted(values: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    # Always zero, but computed: a literal would be folded out of the join keys.
    zero = F.pmod(F.xxhash64(*columns), F.lit(1)).cast("long")
    return values.where(~any_null(columns)).select(*columns, *more, zero.alias("__salt"))


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not f.dataType.simpleString().startswith("map")]


def clash_free(
    source: DataFrame, target: DataFrame, keys: Sequence[Sequence[str]], narrow: bool = False
) -> DataFrame:
    """Source rows that clash with no target row on any key."""
    return reduce(lambda rows, k: without_clash(rows, target, k, narrow), keys, source)


def accepted_rows(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    scratch: Scratch,
    unique_keys: Sequence[Sequence[str]] = (),
    order_by: Sequence[str] = (),
    narrow: bool = False,
) -> DataFrame:
    """The source rows an insert-only load inserts.

    ``narrow`` suits a source that is small beside the target (see ``without_clash``).
    """
    keys = all_keys(key, unique_keys)
    if len(keys) == 1:
        return dedup(clash_free(source, target, keys, narrow), key, order_by, keep="first")
    rows = _placed(source, applied_order(source, key, order_by), scratch)
    met = scratch.write(_incidences(rows, target, keys, narrow), "incidences")
    clashing = met.where("__taken").select("__pos").distinct()
    contested = met.where("NOT __taken").select("__group", "__pos")
    losers = _losers(contested.join(clashing, "__pos", "left_anti"), scratch)
    return _without(rows, clashing.unionAll(losers), scratch).select(*source.columns)


def _placed(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Whole rows with their place in source order as one long.

    Repeats of a whole row follow each other and lose against the first. The range sort
    places rows in order; written once, the places are fixed.
    """
    placed = rows.orderBy(*order).withColumn("__pos", F.monotonically_increasing_id())
    return scratch.write(placed, "candidates")


def _incidences(
    rows: DataFrame, target: DataFrame, keys: Sequence[Sequence[str]], narrow: bool
) -> DataFrame:
    """(__group, __pos, __taken): groups of several rows or of a value in the target.

    A group is named by its first row and the number of its key, so whatever types keys
    have, rounds only handle longs. Values and positions move once a key; rows of the
    target have no position.
    """
    parts = []
    for i, k in enumerate(keys):
        given = rows.where(~any_null(k)).select(*k, "__pos")
        known = target.where(~any_null(k)).select(*k)
        if narrow:  # a small source leaves the target where it is
            known = known.join(given.select(*k).distinct(), list(k), "left_semi").select(*k)
        both = given.unionAll(known.withColumn("__pos", F.lit(None).cast("long")))
        same = Window.partitionBy(*k)
        marked = both.select(
            "__pos",
            F.min("__pos").over(same).alias("__first"),
            F.count("__pos").over(same).alias("__n"),
            F.count(F.lit(1)).over(same).alias("__all"),
        ).where("__pos IS NOT NULL AND __all > 1")
        number = (F.col("__first") * len(keys) + i).alias("__group")
        parts.append(marked.select(number, "__pos", (F.col("__all") > F.col("__n")).alias("__taken")))
    return reduce(DataFrame.unionAll, parts)


# Bits of one bitmap of Spark's.
CHUNK_BITS = 15


def _without(rows: DataFrame, gone: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows whose position is not among ``gone``.

    Positions travel as a bit each, so millions of them are small enough to be broadcast
    and whole rows need not move.
    """
    chunk = F.shiftright("__pos", CHUNK_BITS).alias("__chunk")
    at = F.col("__pos").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    maps = gone.select(chunk, at.alias("__at")).repartition("__chunk").groupBy("__chunk")
    maps = scratch.write(maps.agg(F.bitmap_construct_agg("__at").alias("__bits")), "gone")
    byte = F.substring("__bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(F.lit(7)).cast("int"))
    met = rows.withColumn("__chunk", chunk).join(maps, "__chunk", "left")
    return met.where(F.col("__bits").isNull() | (bit == 0)).select(*rows.columns)


# A round that leaves more than this share of its rows is followed by one that also follows
# single dependencies.
SLOW = 0.75


def _losers(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Positions, among incidences, of the rows that are not accepted."""
    undecided = scratch.write(rows, "undecided")
    left, slow = undecided.count(), False
    lost: list[DataFrame] = [undecided.select("__pos").limit(0)]
    while left:
        marked = _dependencies(undecided)
        if slow:
            decided = _decided(scratch.write(marked, "dependencies"), scratch)
            winners = decided.where("wins").select("__pos")
        else:
            winners = marked.where("up IS NULL").select("__pos")
        winners = scratch.write(winners, "winners")
        taken = undecided.join(winners, "__pos", "left_semi").select("__group").distinct()
        gone = undecided.join(taken, "__group", "left_semi").select("__pos").distinct()
        gone = scratch.write(gone, "gone")
        lost.append(gone.join(winners, "__pos", "left_anti"))
        undecided = scratch.write(undecided.join(gone, "__pos", "left_anti"), "undecided")
        before, left = left, undecided.count()
        slow = left > SLOW * before
        log.info("insert-only: %d incidences left of %d", left, before)
    return reduce(DataFrame.unionByName, lost)


def _dependencies(rows: DataFrame) -> DataFrame:
    """(__pos, up, several): the one row each row depends on, or that there are several.

    In a group the first row depends on nobody, the second on the first, and every later
    one on several.
    """
    first = rows.groupBy("__group").agg(F.min("__pos").alias("__first"))
    marked = rows.join(first, "__group")
    later = marked.where("__pos > __first").groupBy("__group").agg(F.min("__pos").alias("__second"))
    marked = marked.join(later, "__group", "left")
    above = F.when(F.col("__pos") > F.col("__first"), F.col("__first"))
    found = marked.groupBy("__pos").agg(
        F.min(above).alias("up"),
        F.max(above).alias("__other"),
        F.coalesce(F.max(F.col("__pos") > F.col("__second")), F.lit(False)).alias("__third"),
    )
    several = F.col("__third") | F.coalesce(F.col("up") != F.col("__other"), F.lit(False))
    return found.select("__pos", "up", several.alias("several"))


def _decided(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(__pos, wins) of every row whose chain of single dependencies ends at a free row.

    A row wins if its end is free and lies an even number of steps above it. Each round
    doubles how far up the rows look that have not reached their end yet.
    """
    free, several = F.expr("NOT several AND up IS NULL"), F.col("several")
    kinds = rows.select(F.col("__pos").alias("up"), free.alias("free"), (free | several).alias("ended"))
    chained = rows.where("NOT several AND up IS NOT NULL").select("__pos", "up")
    paths = chained.join(kinds, "up").select("__pos", "up", F.lit(True).alias("odd"), "ended", "free")
    paths = scratch.write(paths, "paths")
    while True:
        going = paths.where("NOT ended")
        if going.isEmpty():
            break
        above = paths.select(
            F.col("__pos").alias("up"),
            F.col("up").alias("next"),
            F.col("odd").alias("more"),
            F.col("ended").alias("ends"),
            F.col("free").alias("frees"),
        )
        jumped = going.join(above, "up").select(
            "__pos",
            F.col("next").alias("up"),
            (F.col("odd") != F.col("more")).alias("odd"),
            F.col("ends").alias("ended"),
            F.col("frees").alias("free"),
        )
        paths = scratch.write(paths.where("ended").unionByName(jumped), "paths")
    roots = rows.where(free).select("__pos", F.lit(True).alias("wins"))
    return roots.unionByName(paths.where("free").select("__pos", (~F.col("odd")).alias("wins")))
