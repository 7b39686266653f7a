"""A training corpus from documents: filter, de-duplicate, clean, pack."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import exact_dedup, packing, quality_knn, secret_scan, simhash
from tablesync.llm.common import documents, labels
from tablesync.session import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_knn.keep_accepted(docs, labels(spark, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs, Scratch(spark), keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs, Scratch(spark))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secret_scan.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece, with its ids."""
    return packing.packed(docs, Scratch(spark), public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_knn", quality),
    ("exact_dedup", exact),
    ("simhash", near),
    ("secret_scan", secrets),
    ("packing", pack),
]
# Classifier, fingerprints and tokens have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again.

    What a stage wrote goes as soon as the next one is written, the last when the program
    ends.
    """
    docs, scratch = documents(spark, sf_dir), Scratch(spark)
    for name, stage in STAGES:
        before = list(scratch.paths)
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        for path in before:
            scratch.drop(path)
    return docs
