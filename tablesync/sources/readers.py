"""Opening sources. Each reader fails at once when the source is not there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablesync.session import SharedFiles


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    if not SharedFiles(spark, path).exists():
        raise FileNotFoundError(f"source not found: {path}")
    return spark.read.format(fmt).options(**options).load(path)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers counts and extremes of whole Parquet columns from file footers.

    Aggregates without a filter or group, over columns whose statistics footers hold
    exactly (whole numbers, dates, booleans), then read no data. Files must have been
    written with statistics, else Spark says so. The session shares cluster and catalogue
    with the one given and has settings of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A linked table: any table the session catalog knows."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"linked table does not exist: {name}")
    return spark.table(name)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a database read that is split by ranges of one column.

    A split is all or nothing: without it one task reads the whole table.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}
    split = (partition_column, bounds, partitions)
    if any(part is not None for part in split):
        if any(part is None for part in split):
            raise ValueError("partition_column, bounds and partitions go together")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Filters and column lists given to the result are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def full_scan(source: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows, the named columns in the order given (all of them by default)."""
    return source.select(*columns) if columns else source


# Leaves of a plan that give the same rows however often they are read: files as they
# were listed when the DataFrame was made, and rows that are part of the plan itself.
STEADY_LEAVES = ("HadoopFsRelation", "LocalRelation", "LogicalRDD", "Range", "OneRowRelation")


def reads_alike(df: DataFrame) -> bool:
    """Does every read of this DataFrame give the same rows?

    A database, Python code or a random function can answer differently each time; a run
    writes such a source once and works on what it wrote.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    names = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        name = leaf.getClass().getSimpleName()
        names.append(leaf.relation().getClass().getSimpleName() if name == "LogicalRelation" else name)
    python = any(word in plan.toString() for word in ("InPandas", "InArrow", "PythonUDF", "EvalPython"))
    return plan.deterministic() and not python and all(name in STEADY_LEAVES for name in names)
