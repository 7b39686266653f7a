"""Declared column type text -> target type.

Rules are tried from top to bottom on the upper-cased text; a rule applies when
the text contains one of its words. The order is part of the contract.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words to look for and the name of the target type, in order.
RULES: tuple[tuple[tuple[str, ...], str], ...] = (
    (("BOOL",), "boolean"),
    (("DATETIME", "TIMESTAMP"), "timestamp"),
    (("DATE",), "date"),
    (("DECIMAL", "NUMERIC"), "numeric"),
    (("CHAR", "CLOB", "TEXT"), "text"),
    (("INT",), "bigint"),
    (("REAL", "FLOA", "DOUB"), "double precision"),
    (("BLOB",), "bytea"),
)
EMPTY_TYPE = "text"
OTHER_TYPE = "numeric"
PRECISION_PATTERN = r"\(\s*(\d+)\s*,\s*(\d+)\s*\)"

SPARK_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "numeric": T.DecimalType(38, 18),
    "text": T.StringType(),
    "bigint": T.LongType(),
    "double precision": T.DoubleType(),
    "bytea": T.BinaryType(),
}


def type_name_column(declared: Column) -> Column:
    """The rule table as a column expression over a column of type texts."""
    text = F.upper(F.coalesce(declared, F.lit("")))
    pattern = F.lit(PRECISION_PATTERN)
    precise = F.concat(
        F.lit("numeric("),
        F.regexp_extract(text, PRECISION_PATTERN, 1),
        F.lit(","),
        F.regexp_extract(text, PRECISION_PATTERN, 2),
        F.lit(")"),
    )
    chain = F.when(text == "", F.lit(EMPTY_TYPE))
    for words, name in RULES:
        hit = reduce(lambda a, b: a | b, [text.contains(word) for word in words])
        if name == "numeric":
            chain = chain.when(hit & F.regexp_like(text, pattern), precise)
        chain = chain.when(hit, F.lit(name))
    return chain.otherwise(F.lit(OTHER_TYPE))


def type_name(declared: str | None) -> str:
    text = (declared or "").upper()
    if not text:
        return EMPTY_TYPE
    for words, name in RULES:
        if any(word in text for word in words):
            found = re.search(PRECISION_PATTERN, text) if name == "numeric" else None
            return f"numeric({found[1]},{found[2]})" if found else name
    return OTHER_TYPE


def spark_type(declared: str | None) -> T.DataType:
    """Spark type for a declared type. Precisions Spark cannot hold are errors."""
    name = type_name(declared)
    if name in SPARK_TYPES:
        return SPARK_TYPES[name]
    precision, scale = (int(part) for part in re.findall(r"\d+", name))
    if not 1 <= precision <= 38 or scale > precision:
        raise ValueError(f"no decimal type for {declared!r}")
    return T.DecimalType(precision, scale)


def sql_type_name(kind: T.DataType) -> str:
    """Column type text for a Spark type, for adding a column to a database table."""
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    names = {spark_kind: name for name, spark_kind in SPARK_TYPES.items()}
    if kind in names:
        return names[kind]
    return kind.simpleString()
