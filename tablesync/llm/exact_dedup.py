"""Exact duplicates: runs of digests that meet as a tree, with SQL functions alone.

Each round aggregates by digest; runs are neither sorted nor merged in order. What one
partition has of a digest collapses before it moves, which is the run of that partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import fresh
from tablesync.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs that meet in a round: two rounds for up to 256 partitions, five for a million.
FAN_IN = 16


def normalized(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; NULL reads as empty."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, digest, and two plain facts about the text that verify an equal digest."""
    norm = normalized(F.col(text))
    return df.select(
        F.col(key).alias("id"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.octet_length(norm).cast("long").alias("bytes"),
        F.xxhash64(norm).alias("check"),
        F.spark_partition_id().alias("run"),
    )


def tree_merge(runs: DataFrame, count: int, scratch: Scratch, keep: str, fan_in: int) -> DataFrame:
    """Merge runs of (digest, bytes, check, winner, size) until one run is left.

    In each round, runs whose numbers share all but their last base-``fan_in`` digit meet:
    both are dealt by digest, so no task ever holds a whole run, and equal digests of the
    met runs become one entry that keeps the best identifier. An entry only joins entries
    of the same length and second hash. Partial aggregates collapse a digest before it
    moves, so a text with very many copies is one entry per task. The last round's result
    is written to the shared folder sorted by digest.
    """
    if fan_in < 2:
        raise ValueError(f"at least two runs must meet in a round, not {fan_in}")
    best = F.max if keep == "largest" else F.min
    same = ("digest", "bytes", "check")
    while True:
        count = -(-count // fan_in)
        up = F.floor(F.col("run") / fan_in) if count > 1 else F.lit(0)
        runs = runs.withColumn("run", up.cast("int")).groupBy("run", *same)
        runs = runs.agg(best("winner").alias("winner"), F.sum("size").alias("size"))
        if count <= 1:
            break
    merged = runs.drop("run").sortWithinPartitions("digest")
    return scratch.write(merged, "digests")


def exact_duplicates(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The row
    with the ``keep`` ("smallest" or "largest") id of a group stays. Repeated rows are
    rows of their own: with the same id twice, both are kept or neither. NULL ids stay
    only in groups that have no other id, and then keep_id is NULL and kept true. An
    empty table gives an empty result; other columns are not read.
    """
    facts = scratch.write(digests(df, key, text), "facts")
    count = (facts.agg(F.max("run")).first()[0] or 0) + 1
    first = facts.select(
        "run", "digest", "bytes", "check", F.col("id").alias("winner"), F.lit(1).cast("long").alias("size")
    )
    merged = tree_merge(first, count, scratch, keep, fan_in)
    # single texts decide for themselves; only real groups are looked up
    groups = merged.where("size > 1").select("digest", "bytes", "check", "winner", "size")
    joined = facts.join(groups, ["digest", "bytes", "check"], "left")
    winner = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("winner"))
    return joined.select(
        "id",
        winner.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(winner).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows that stay, with all their columns.

    A row is looked up by its id and its digest, so an id that stands for several texts
    loses only the rows that lose.
    """
    lost = exact_duplicates(df, scratch, key, text, keep).where("NOT kept")
    lost_id, lost_text = fresh(df, "_lost_id"), fresh(df, "_lost")
    lost = lost.select(F.col("id").alias(lost_id), F.col("text_sha256").alias(lost_text)).distinct()
    digest = F.sha2(normalized(df[text]), 256)
    return df.join(lost, df[key].eqNullSafe(F.col(lost_id)) & (digest == F.col(lost_text)), "left_anti")
