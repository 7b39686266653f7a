"""Cell text for a preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the preview format.
MAX_CELL_WIDTH = 40
NULL_TEXT = "NULL"
CUT_MARK = "…"


def display_cell(value: Column, source: T.DataType) -> Column:
    """NULL by name, bytes by size, long text cut to the cell width with a mark."""
    if isinstance(source, T.BinaryType):
        shown = F.format_string("<BLOB %dB>", F.octet_length(value))
    else:
        text = value if isinstance(source, T.StringType) else value.cast("string")
        cut = F.concat(F.substring(text, 1, MAX_CELL_WIDTH - 1), F.lit(CUT_MARK))
        shown = F.when(F.length(text) <= MAX_CELL_WIDTH, text).otherwise(cut)
    return F.when(value.isNull(), F.lit(NULL_TEXT)).otherwise(shown)


def display_cells(df: DataFrame) -> DataFrame:
    return df.select(*[display_cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
