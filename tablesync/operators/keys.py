"""Key high-water: where an allocator of key values has to continue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_high_water(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its maximum, 1 for an empty table. One scan for all."""
    tops = table.agg(
        *[F.coalesce(F.max(c).cast("long"), F.lit(1).cast("long")).alias(c) for c in columns]
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("high_water")) for c in columns
    ]
    return tops.select(F.inline(F.array(*pairs)))


def high_water_map(table: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    if not columns:
        return {}
    return {row["column"]: row["high_water"] for row in key_high_water(table, columns).collect()}
