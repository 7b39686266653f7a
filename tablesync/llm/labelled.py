"""Labelled documents for the classifiers: which rows may teach, and a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import crc_remainder


def teaching_rows(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, key: str = "doc_id"
) -> DataFrame:
    """(doc_id, label): labelled rows that have a document and are not held out.

    Rows without a key or with a label other than 0 and 1 teach nothing.
    """
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (crc_remainder("doc_id", modulus) != held_out))
    return known.join(docs.select(F.col(key).alias("doc_id")).distinct(), "doc_id", "left_semi")


def sample(rows: DataFrame, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those of the smallest hashed keys."""
    order = (F.xxhash64("doc_id"), "doc_id")
    parts = [rows.where(F.col("label") == c).orderBy(*order).limit(per_label) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def with_texts(rows: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, label, text) for teaching rows."""
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return texts.join(rows, "doc_id")


def held_out_column(modulus: int, held_out: int, key: str = "doc_id"):
    return F.coalesce(crc_remainder(key, modulus) == held_out, F.lit(False))
