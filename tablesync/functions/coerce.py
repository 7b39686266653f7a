"""Source values -> target types, as built-in column expressions.

Boolean and binary targets have their own rules; every other pair is an
assignment: a cast that fails the run when a value does not fit. Casts rely on
ANSI mode (``require_ansi``), so nothing silently turns into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.spec import TRUE_WORDS

# White space at either end of a text: the Unicode property plus the four
# separator control characters.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def require_ansi(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("coercion needs spark.sql.ansi.enabled=true")


def to_boolean(value: Column, source: T.DataType) -> Column:
    """NULL stays NULL, numbers are true unless zero, texts only by the word list."""
    if isinstance(source, T.BooleanType):
        return value
    if isinstance(source, T.NumericType):
        return value != F.lit(0)
    if isinstance(source, T.StringType):
        return F.lower(F.regexp_replace(value, _OUTER_SPACE, "")).isin(*TRUE_WORDS)
    if isinstance(source, T.BinaryType):
        return F.octet_length(value) > 0
    return F.when(value.isNotNull(), F.lit(True))


def to_binary(value: Column, source: T.DataType) -> Column:
    """Bytes stay bytes and text becomes its UTF-8 bytes; nothing else fits."""
    if isinstance(source, T.BinaryType):
        return value
    if isinstance(source, T.StringType):
        return F.encode(value, "UTF-8")
    raise TypeError(f"{source.simpleString()} values do not fit a binary column")


def to_target(value: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(source, T.NullType):
        return value.cast(target)
    if isinstance(target, T.BooleanType):
        return to_boolean(value, source)
    if isinstance(target, T.BinaryType):
        return to_binary(value, source)
    if source == target:
        return value
    unfit = (
        isinstance(source, T.BinaryType)
        or (isinstance(source, T.NumericType) and isinstance(target, _TIME))
        or (isinstance(source, _TIME) and isinstance(target, T.NumericType))
        or (isinstance(source, T.BooleanType) and isinstance(target, T.NumericType))
    )
    if unfit:
        raise TypeError(f"no assignment from {source.simpleString()} to {target.simpleString()}")
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _FLOATING):
            return F.rint(value).cast(target)  # half to even
        if isinstance(source, T.DecimalType):
            return F.round(value, 0).cast(target)  # half away from zero
    return value.cast(target)


def coerce_to(source: DataFrame, target: T.StructType, *more: Column) -> DataFrame:
    """Source columns the target also has, in target order and types, and ``more`` as they are."""
    types = {f.name: f.dataType for f in source.schema.fields}
    return source.select(
        *[
            to_target(F.col(_quoted(f.name)), types[f.name], f.dataType).alias(f.name)
            for f in target.fields
            if f.name in types
        ],
        *more,
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
