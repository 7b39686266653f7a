"""The place of a source row in the files it was read from.

A source without a declared order counts as applied in the order it is read. For files
that is known without reading anything more: Spark offers each row's file and its number
in the file as hidden columns. Neither is stored in a target.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.spec import SCAN_ORDER

POSITION = SCAN_ORDER


def with_position(df: DataFrame) -> DataFrame:
    """Rows with ``POSITION``: files in the order of their paths, rows as they lie in them.

    Unchanged where rows have no such place: not read from files, of a format that does not
    number rows, or behind a join of several files or an aggregate.
    """
    if POSITION in df.columns:
        return df
    try:
        hidden = df.metadataColumn("_metadata")
        row = hidden.getField("row_index").alias("row")
        placed = df.select("*", F.struct(hidden.getField("file_path").alias("file"), row).alias(POSITION))
        if len(df.inputFiles()) > 1:
            return placed
        return df.select("*", F.struct(F.lit("").alias("file"), row).alias(POSITION))  # short
    except AnalysisException:
        return df
