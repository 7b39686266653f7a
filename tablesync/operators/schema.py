"""Schema comparison and additive evolution: columns are added, never dropped or retyped."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.spec import check_columns

from tablesync.functions.declared_types import spark_type

ADD, TARGET_ONLY, RETYPE = "add", "target_only", "retype"


@dataclass(frozen=True)
class SchemaDiff:
    """``missing`` columns could be added; the other two are reported, never changed."""

    missing: tuple[T.StructField, ...]
    target_only: tuple[str, ...]
    retyped: tuple[tuple[str, str, str], ...]

    def added(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.missing}


def schema_diff(
    source: T.StructType, target: T.StructType, declared: Mapping[str, str] | None = None
) -> SchemaDiff:
    """Compare by name. A new column takes its declared type, else the source type."""
    declared = declared or {}
    has = {f.name: f.dataType for f in target.fields}
    missing, retyped = [], []
    for f in source.fields:
        kind = spark_type(declared[f.name]) if f.name in declared else f.dataType
        if f.name not in has:
            missing.append(T.StructField(f.name, kind, True))
        elif has[f.name] != kind:
            retyped.append((f.name, has[f.name].simpleString(), kind.simpleString()))
    extra = [name for name in target.names if name not in source.names]
    return SchemaDiff(tuple(missing), tuple(extra), tuple(retyped))


def schema_plan(spark: SparkSession, table: str, diff: SchemaDiff) -> DataFrame:
    """The diff as rows (table, column, type, action); nothing is executed."""
    rows = [(table, f.name, f.dataType.simpleString(), ADD) for f in diff.missing]
    rows += [(table, name, None, TARGET_ONLY) for name in diff.target_only]
    rows += [(table, name, f"{old} -> {new}", RETYPE) for name, old, new in diff.retyped]
    return spark.createDataFrame(rows, "table string, column string, type string, action string")


def schema_diff_counts(source: DataFrame, target: DataFrame, diff: SchemaDiff) -> DataFrame:
    """Per differing column: action, type and how many rows hold a value.

    Values of columns to add are counted in the source (what a back-fill would
    write), the others in the target. One narrow scan per side.
    """
    kinds = {f.name: f.dataType for f in target.schema.fields}
    add = [(f.name, ADD, f.dataType.simpleString()) for f in diff.missing]
    kept = [(n, TARGET_ONLY, kinds[n].simpleString()) for n in diff.target_only]
    kept += [(n, RETYPE, f"{old} -> {new}") for n, old, new in diff.retyped]
    parts = [_value_counts(df, rows) for df, rows in ((source, add), (target, kept)) if rows]
    if not parts:
        raise ValueError("schemas do not differ")
    return reduce(DataFrame.unionAll, parts)


def _value_counts(df: DataFrame, rows: list[tuple[str, str, str]]) -> DataFrame:
    counts = df.agg(*[F.count(name).alias(name) for name, _, _ in rows])
    structs = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(action).alias("action"),
            F.lit(kind).alias("type"),
            F.col(name).alias("n_values"),
        )
        for name, action, kind in rows
    ]
    return counts.select(F.inline(F.array(*structs)))


def evolved(target: T.StructType, diff: SchemaDiff) -> T.StructType:
    """The target's columns and those it gains; names that clash are refused here."""
    combined = T.StructType([*target.fields, *diff.missing])
    check_columns(combined)
    return combined


def add_columns(target: DataFrame, diff: SchemaDiff) -> DataFrame:
    """Target with the missing columns as NULL; again is a no-op."""
    new = {
        f.name: F.lit(None).cast(f.dataType) for f in diff.missing if f.name not in target.columns
    }
    return target.withColumns(new) if new else target


def column_intersection(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows cut to the columns both sides have, in target order."""
    present = set(source.columns)
    return source.select(*[c for c in target.columns if c in present])
