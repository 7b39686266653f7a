"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most text bytes handed to Python code at once; one longer text is a batch of its own.
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A name like this one that no column has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_remainder(key: Column | str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo a number; NULL keys give NULL."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % modulus


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker, kept between its tasks (vocabularies, codebooks)."""
    store = sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str
) -> DataFrame:
    """Apply a function to Arrow batches cut so that their texts stay within BATCH_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut_batch(batch, text):
                yield function(part)

    return df.mapInArrow(run, schema)


def cut_batch(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    start = size = 0
    lengths = pa.compute.binary_length(batch.column(text)).to_pylist()
    for i, length in enumerate(lengths):
        if i > start and size + (length or 0) > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length or 0
    if start < len(lengths):
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """Whole texts; NULL reads as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]
