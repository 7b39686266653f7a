"""Looking at tables: counts, a limited preview, ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PREVIEW_ROWS = 200


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, all in one job; tables of a ``footer_session`` read no data."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def preview(df: DataFrame, order_by: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows by ``order_by`` and whether more rows follow.

    A top-n of n+1 rows: each task keeps its own first rows. The window only sees
    those n+1 rows.
    """
    head = df.orderBy(*order_by).limit(n + 1)
    rows = Window.orderBy(*order_by)
    seen = head.select(
        "*",
        F.row_number().over(rows).alias("__n"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("__seen"),
    )
    return seen.where(F.col("__n") <= n).select(*df.columns, (F.col("__seen") > n).alias("truncated"))


def run_sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a query over named tables; sources are DataFrames, so it only reads."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)
