"""Coercion, declared types, cell display, option parsing."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import coerce_to, require_ansi, to_target
from tablesync.functions.declared_types import spark_type, type_name, type_name_column
from tablesync.functions.display import display_cells
from tablesync.spec import SyncOptions, TableSpec, check_columns, check_identifier


def coerced(spark, values, source, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {source}")
    kind = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", target)])
    return [r.v for r in coerce_to(df, kind).orderBy("i").collect()]


@pytest.mark.parametrize(
    "source, values, expected",
    [
        ("string", ["1", "t", "TRUE", "y", "yes", "ON", " Yes ", "\ton\n", "　on\x1c"], True),
        ("string", ["0", "f", "no", "off", "2", "", "abc", "tru e", "1.0"], False),
        ("int", [1, -1, 7], True),
        ("int", [0], False),
        ("double", [0.5, float("nan"), float("inf")], True),
        ("double", [0.0, -0.0], False),
        ("decimal(10,2)", [Decimal("0.01")], True),
        ("binary", [b"\x00", b"0"], True),
        ("binary", [b""], False),
        ("boolean", [True], True),
    ],
)
def test_boolean_truth_table(spark, source, values, expected):
    out = coerced(spark, [*values, None], source, T.BooleanType())
    assert out == [expected] * len(values) + [None]


def test_binary_target(spark):
    texts = ["abc", "żółw €", "", None]
    expected = [None if t is None else bytearray(t, "utf-8") for t in texts]
    assert coerced(spark, texts, "string", T.BinaryType()) == expected
    assert coerced(spark, [b"\xff", None], "binary", T.BinaryType()) == [bytearray(b"\xff"), None]
    with pytest.raises(TypeError):
        to_target(F.col("v"), T.IntegerType(), T.BinaryType())


def test_assignment_casts(spark):
    assert coerced(spark, [2.5, 3.5, -2.5, None], "double", T.LongType()) == [2, 4, -2, None]
    assert coerced(spark, [Decimal("2.5"), Decimal("-2.5")], "decimal(4,1)", T.LongType()) == [3, -3]
    assert coerced(spark, [" 12 "], "string", T.LongType()) == [12]
    assert coerced(spark, ["2024-01-02 03:04:05"], "string", T.TimestampNTZType()) == [
        dt.datetime(2024, 1, 2, 3, 4, 5)
    ]
    assert coerced(spark, [7], "int", T.StringType()) == ["7"]


@pytest.mark.parametrize(
    "source, value, target",
    [
        ("string", "x", T.LongType()),
        ("string", "", T.TimestampNTZType()),
        ("bigint", 2**40, T.IntegerType()),
        ("string", "123456789012345678901234567890", T.DecimalType(38, 18)),
    ],
)
def test_values_that_do_not_fit_fail(spark, source, value, target):
    with pytest.raises(Exception):
        coerced(spark, [value], source, target)


@pytest.mark.parametrize(
    "source, target",
    [
        (T.BinaryType(), T.StringType()),
        (T.LongType(), T.TimestampNTZType()),
        (T.BooleanType(), T.LongType()),
        (T.DateType(), T.LongType()),
    ],
)
def test_pairs_without_assignment(source, target):
    with pytest.raises(TypeError):
        to_target(F.col("v"), source, target)


def test_coercion_needs_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError):
            require_ansi(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    require_ansi(spark)


DECLARED = {
    "BOOLEAN": "boolean", "bool": "boolean", "DATETIME": "timestamp", "TIMESTAMPTZ": "timestamp",
    "DATE": "date", "LAST_UPDATED": "date", "DECIMAL(10,2)": "numeric(10,2)",
    "NUMERIC( 10 , 2 )": "numeric(10,2)", "NUMERIC(10)": "numeric", "numeric": "numeric",
    "NVARCHAR(20)": "text", "CLOB": "text", "TEXT": "text", "CHARINT": "text", "INT": "bigint",
    "BIGINT UNSIGNED": "bigint", "POINT": "bigint", "INTERVAL": "bigint",
    "REAL": "double precision", "FLOAT": "double precision", "DOUBLE": "double precision",
    "BLOB": "bytea", "": "text", None: "text", "JSON": "numeric", "TIME": "numeric",
    "STRING": "numeric", "VARBINARY": "numeric", "JSON(3,1)": "numeric",
}


def test_declared_types_driver_and_column(spark):
    assert {d: type_name(d) for d in DECLARED} == DECLARED
    df = spark.createDataFrame([(d,) for d in DECLARED], "d string")
    out = df.select("d", type_name_column(F.col("d")).alias("t")).collect()
    assert {r.d: r.t for r in out} == DECLARED


def test_declared_spark_types():
    assert spark_type("DATETIME") == T.TimestampNTZType()
    assert spark_type("DECIMAL(10,2)") == T.DecimalType(10, 2)
    assert spark_type("NUMERIC") == T.DecimalType(38, 18)
    for bad in ("DECIMAL(39,2)", "DECIMAL(5,6)", "DECIMAL(0,0)"):
        with pytest.raises(ValueError):
            spark_type(bad)


def test_display_cells(spark):
    df = spark.createDataFrame(
        [("a" * 40, b"xyz", 5, None), ("é" * 41, b"", None, "n")], "s string, b binary, i int, n string"
    )
    first, second = display_cells(df).collect()
    assert tuple(first) == ("a" * 40, "<BLOB 3B>", "5", "NULL")
    assert tuple(second) == ("é" * 39 + "…", "<BLOB 0B>", "NULL", "n")


def test_identifiers_and_specs():
    assert check_identifier("tabelle_ü1") == "tabelle_ü1"
    for bad in ("", "a-b", "a b", 'a"b'):
        with pytest.raises(ValueError):
            check_identifier(bad)
    with pytest.raises(ValueError):
        TableSpec("t", ())
    with pytest.raises(ValueError):
        TableSpec("t", "k", identity=("v",))
    with pytest.raises(ValueError):
        check_columns(T.StructType().add("a", "int").add("A", "int"))
    with pytest.raises(ValueError):
        TableSpec("t", "k", unique_keys=("u",)).check_source(T.StructType().add("k", "int"))
    assert TableSpec("t", "k", unique_keys=("u", ("a", "b"))).unique_keys == (("u",), ("a", "b"))


def test_options_join_flags_and_settings():
    options = SyncOptions.from_flags(
        {"prune": True, "insert_only": False, "incremental_col": "ts"},
        {"insert_only": " Yes ", "allow_prune": "off", "add_columns": "0"},
    )
    assert options.insert_only and options.prune and not options.add_columns
    with pytest.raises(PermissionError):
        options.check_prune()
    SyncOptions.from_flags({"prune": True}, {"allow_prune": "1"}).check_prune()
    # The policy cannot be switched on by a flag.
    assert not SyncOptions.from_flags({"allow_prune": True}, {}).allow_prune
