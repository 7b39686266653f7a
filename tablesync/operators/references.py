"""References between tables: rows without a parent, and parents before children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.constraints import any_null


def missing_parents(
    rows: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Distinct values of a reference that no parent row has, and how many rows have them.

    A reference with a NULL in it refers to nothing and is never missing. Values are counted
    before they are exchanged, so a parent that a third of all rows name costs one value a
    task.
    """
    named = rows.where(~any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parent_columns)])
    same = [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(columns)]
    return named.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def orphan_rows(
    rows: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Rows whose reference no parent row has.

    Whole rows only meet the missing values, which are few or none as a rule and then are
    broadcast at run time.
    """
    missing = missing_parents(rows, parent, columns, parent_columns).drop("n_rows")
    return rows.join(missing, list(columns), "left_semi").select(*rows.columns)


def levels(parents: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """Tables in levels: all parents of a table lie in levels before its own.

    Tables keep their order inside a level. A table may refer to itself, and to tables that
    are not named here; a cycle of several tables is refused.
    """
    left = {t: {p for p in named if p in parents and p != t} for t, named in parents.items()}
    found: list[list[str]] = []
    while left:
        ready = [t for t, named in left.items() if not named & left.keys()]
        if not ready:
            raise ValueError(f"tables refer to each other in a cycle: {sorted(left)}")
        found.append(ready)
        for t in ready:
            del left[t]
    return found
