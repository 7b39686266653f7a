"""Incremental reads: the stored maximum of a column and the filter built on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.constraints import any_null


@dataclass(frozen=True)
class Watermark:
    """Highest value of ``column`` seen so far, as text plus its Spark type."""

    column: str
    type: str
    value: str

    def literal(self) -> Column:
        if self.type == "timestamp":  # stored as microseconds: no session time zone
            return F.timestamp_micros(F.lit(int(self.value)))
        return F.lit(self.value).cast(self.type)

    def as_dict(self) -> dict[str, str]:
        return {"column": self.column, "type": self.type, "value": self.value}

    @classmethod
    def from_dict(cls, entry: dict | None) -> Watermark | None:
        try:
            return cls(str(entry["column"]), str(entry["type"]), str(entry["value"]))
        except (TypeError, KeyError):
            return None


def watermark_text(column: Column, kind: T.DataType) -> Column:
    """Text form that ``Watermark.literal`` reads back without loss."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    return column.cast("string")


def applicable(saved: Watermark | None, column: str, full_refresh: bool) -> Watermark | None:
    """The bound of this run: none on a refresh, a first run, or another column."""
    if full_refresh or saved is None or saved.column != column:
        return None
    return saved


def read_since(source: DataFrame, column: str, bound: Watermark | None) -> DataFrame:
    """Rows at or above the bound; ties of the bound are read again on purpose.

    Without a bound every row is read. With one, rows whose value is NULL are not.
    """
    if bound is None:
        return source
    return source.where(F.col(column) >= bound.literal())


def watermark_max(source: DataFrame, column: str, bound: Watermark | None = None) -> DataFrame:
    """Maximum of ``column``, never below the bound, NULLs ignored: one row."""
    return source.agg(_highest(column, bound).alias("watermark"))


def _highest(column: str, bound: Watermark | None) -> Column:
    # greatest() skips NULL, so an increment without values leaves the bound.
    return F.max(column) if bound is None else F.greatest(F.max(column), bound.literal())


@dataclass(frozen=True)
class ReadSummary:
    rows: int
    null_keys: int
    watermark: Watermark | None


def summary_figures(
    key: Sequence[str], column: str | None, kind: T.DataType | None, bound: Watermark | None,
    counted: Column | None = None,
) -> list[Column]:
    """Aggregates that make up a summary; only rows that ``counted`` holds for count."""
    counted = F.lit(True) if counted is None else counted
    figures = [
        F.count_if(counted).alias("n"),
        F.count_if(counted & any_null(key)).alias("nulls"),
    ]
    if column:
        figures.append(watermark_text(_highest(column, bound), kind).alias("top"))
    return figures


def summary_of(figures: Mapping, column: str | None, kind: T.DataType | None) -> ReadSummary:
    top = figures["top"] if column else None
    mark = Watermark(column, kind.simpleString(), top) if top is not None else None
    return ReadSummary(figures["n"], figures["nulls"], mark)


def read_summary(
    source: DataFrame, key: Sequence[str], column: str | None, bound: Watermark | None
) -> ReadSummary:
    """Row count, NULL keys and next watermark of what a run reads, in one scan.

    Run this before the rows are read: a row that reaches a live source in between
    is then read again next time instead of being lost below the watermark.
    """
    kind = source.schema[column].dataType if column else None
    row = source.agg(*summary_figures(key, column, kind, bound)).first()
    return summary_of(row.asDict(), column, kind)
