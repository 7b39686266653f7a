"""Tables as the session's catalogue knows them: columns, and the key as a property.

Spark's catalogue has no keys. A key declared once with ``declare_key`` stays with the
table, so later runs build their ``TableSpec`` from the catalogue alone.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.spec import TableSpec, check_columns

KEY_PROPERTY, UNIQUE_PROPERTY = "tablesync.key", "tablesync.unique_keys"
COLUMNS = "column string, ordinal int, type string, key_ordinal int"


def declare_key(
    spark: SparkSession, table: str, key: Sequence[str], unique_keys: Sequence[Sequence[str]] = ()
) -> None:
    """Keep a table's key, in key order, and unique keys with its catalogue entry."""
    schema = spark.table(table).schema
    check_columns(schema)
    absent = [c for c in [*key, *(c for u in unique_keys for c in u)] if c not in schema.names]
    if absent or not key:
        raise ValueError(f"columns not in {table}: {absent}" if absent else f"{table} needs a key")
    values = {KEY_PROPERTY: list(key), UNIQUE_PROPERTY: [list(u) for u in unique_keys]}
    pairs = ", ".join(f"'{name}' = '{_quoted(json.dumps(value))}'" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _property(spark: SparkSession, table: str, name: str) -> list:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(found[name]) if name in found else []


def columns_of(spark: SparkSession, table: str) -> DataFrame:
    """(column, ordinal, type, key_ordinal): the columns of a table, one row each.

    ``key_ordinal`` counts from 1 and is NULL for columns outside the key.
    """
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table does not exist: {table}")
    key = _property(spark, table, KEY_PROPERTY)
    rows = [
        (f.name, i, f.dataType.simpleString(), key.index(f.name) + 1 if f.name in key else None)
        for i, f in enumerate(spark.table(table).schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def key_list(columns: DataFrame) -> DataFrame:
    """The key's columns in key order as one text, for each group of rows given: one row."""
    listed = F.expr("listagg(`column`, ', ') WITHIN GROUP (ORDER BY key_ordinal)")
    return columns.where("key_ordinal IS NOT NULL").agg(listed.alias("key_columns"))


def spec_of(spark: SparkSession, table: str, name: str | None = None) -> TableSpec:
    """The ``TableSpec`` of a catalogue table whose key was declared."""
    key = [
        r["column"]
        for r in columns_of(spark, table).where("key_ordinal IS NOT NULL").orderBy("key_ordinal").collect()
    ]
    unique = _property(spark, table, UNIQUE_PROPERTY)
    return TableSpec(name or table.rsplit(".", 1)[-1].strip("`"), key, tuple(map(tuple, unique)))


def key_columns(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Key columns of catalogue tables, with what they hold.

    (table, column, ordinal, key_ordinal, type, key_columns, n_rows, n_nulls): one row for
    each key column; one narrow scan a table. ``tables`` gives the name to show for each.
    """
    parts = []
    for shown, table in tables.items():
        columns = columns_of(spark, table)
        key = spec_of(spark, table, "t").key
        listed = key_list(columns).first()["key_columns"]
        counts = spark.table(table).agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in key]
        )
        held = counts.select(
            "n_rows",
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_nulls")) for c in key])),
        )
        parts.append(
            columns.join(held, "column").select(
                F.lit(shown).alias("table"), "column", "ordinal", "key_ordinal", "type",
                F.lit(listed).alias("key_columns"), "n_rows", "n_nulls",
            )
        )
    return reduce(DataFrame.unionByName, parts)
