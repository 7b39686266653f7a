"""Prune: target rows whose key left the source.

The source keys are made distinct before the join. A key repeated in the source
would otherwise travel once per row, and a semi or anti join cannot split a heavy
right side; distinct keys combine before the exchange and leave the partitioning
the join needs.

Rows of keys alone compress to a few bytes, so adaptive execution, which sizes tasks by
shuffled bytes, would sort millions of them in one task. Keys are therefore dealt to a
fixed number of tasks, ``spark.sql.shuffle.partitions``, which it does not merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.classify import IN_SOURCE


def dealt_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns alone, in as many tasks as the session has shuffle partitions."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*key).repartition(tasks, *key)


def prune_keys(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys to remove. An empty source removes every row."""
    there = source.select(*key).distinct().withColumn(IN_SOURCE, F.lit(True))
    # not an anti-join: that would be moved below the dealing
    found = dealt_keys(target, key).join(there, list(key), "left")
    return found.where(F.col(IN_SOURCE).isNull()).select(*key)


def prune_keep(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that stay."""
    stays = target.join(source.select(*key).distinct(), list(key), "left_semi")
    return stays.select(*target.columns)
