"""Source order from files, one-pass figures, violation ranges, catalogue and footers."""

from __future__ import annotations

import pytest
from conftest import SF01, rows_of
from pyspark.sql import functions as F

from tablesync import SCAN_ORDER, ConstraintError, SyncOptions, TableSpec, link_sync, sync_table
from tablesync.operators import duplicates, inspect, keys
from tablesync.operators.position import POSITION, with_position
from tablesync.plans import job
from tablesync.sources import catalogue
from tablesync.sources.readers import footer_session

ROWS = [(1, "c", 5), (2, "x", 9), (1, "a", 5), (1, "b", 4), (None, "n", 1), (None, "m", 1)]
SCHEMA = "k int, v string, ts int"


@pytest.fixture
def files(spark, tmp_path):
    """Two files whose names say which comes first."""
    for i, rows in enumerate((ROWS[:3], ROWS[3:])):
        df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        df.write.parquet(str(tmp_path / f"in/part={i}"))
    return spark.read.parquet(str(tmp_path / "in")).drop("part")


def test_rows_of_a_key_by_place(files):
    assert with_position(with_position(files)).columns == [*files.columns, POSITION]
    last = rows_of(duplicates.dedup(files, ("k",)))
    first = rows_of(duplicates.dedup(files, ("k",), keep="first"))
    assert last == sorted([(1, "b", 4), (2, "x", 9), (None, "m", 1)], key=repr)
    assert first == sorted([(1, "c", 5), (2, "x", 9), (None, "n", 1)], key=repr)
    assert (1, "a", 5) in rows_of(duplicates.dedup(files, ("k",), ("ts",)))  # ties by place
    plan = duplicates.dedup(files, ("k",))._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line]
    assert aggregates and all("v#" not in line for line in aggregates)  # whole rows are not reduced


def test_rows_without_a_place_go_by_value(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    assert with_position(rows).columns == rows.columns
    assert (1, "c", 5) in rows_of(duplicates.dedup(rows, ("k",), ("ts",)))
    counted = rows.groupBy("k").count()
    assert with_position(counted).columns == counted.columns
    odd = rows.withColumn("_metadata", F.lit("mine"))
    assert with_position(odd).columns == odd.columns


def test_runs_apply_rows_as_they_are_read(spark, files, new_target):
    given = files.where("k IS NOT NULL")
    for policy, row, affected in (("last", (1, "b", 4), 4), ("first", (1, "c", 5), 2)):
        target = new_target(policy)
        target.create(TableSpec("t", "k"), given.schema)
        report = sync_table(spark, TableSpec("t", "k"), given, target, SyncOptions(on_duplicate=policy))
        assert rows_of(target.load()) == [row, (2, "x", 9)]
        assert (report.read_rows, report.affected_rows) == (4, affected)
        again = sync_table(spark, TableSpec("t", "k"), given, target, SyncOptions(on_duplicate=policy))
        assert rows_of(target.load()) == [row, (2, "x", 9)] and again.read_rows == 4
    declared = TableSpec("t", "k", order_by=("ts", SCAN_ORDER))
    target = new_target("declared")
    target.create(declared, given.schema)
    sync_table(spark, declared, given, target, SyncOptions(insert_only=True))
    assert rows_of(target.load()) == [(1, "b", 4), (2, "x", 9)]
    memory = spark.createDataFrame([(1, "q", 1)], SCHEMA)
    with pytest.raises(ValueError, match="no place"):
        sync_table(spark, declared, memory, target)


def test_a_whole_run_reads_its_source_once(spark, files, new_target, monkeypatch):
    """Counts, NULL keys, repeats and the watermark come with the write of the changes."""
    given = files.where("k = 2 OR v = 'c'")
    target = new_target()
    link_sync(spark, TableSpec("t", "k"), given, target)

    def not_needed(*_):
        raise AssertionError("another scan of the source")

    for name in ("read_summary", "repeated_keys"):
        monkeypatch.setattr(job, name, not_needed)
    options = SyncOptions(incremental_col="ts", full_refresh=True, prune=True, allow_prune=True)
    changed = given.withColumn("v", F.concat("v", F.lit("!"))).where("k = 2")
    report = sync_table(spark, TableSpec("t", "k"), changed, target, options)
    assert (report.read_rows, report.affected_rows, report.deleted_rows) == (1, 1, 1)
    assert report.watermark == "9" and rows_of(target.load()) == [(2, "x!", 9)]
    report = sync_table(spark, TableSpec("t", "k"), changed.where("false"), target, options)
    assert (report.read_rows, report.deleted_rows, target.load().count()) == (0, 1, 0)
    with pytest.raises(ConstraintError, match="not null"):
        sync_table(spark, TableSpec("t", "k"), files.where("v = 'n'"), target)


def test_a_violation_tells_where_its_rows_are(spark, tmp_path, new_target):
    spec = TableSpec("t", "k", unique_keys=(("v",),))
    rows = [(1, "a", 1), (2, "b", 1), (3, "c", 1), (4, "b", 1), (5, "d", 1)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    given = spark.read.parquet(str(tmp_path / "in"))
    target = new_target()
    target.create(spec, given.schema)
    with pytest.raises(ConstraintError, match="source rows 1 to 3") as caught:
        sync_table(spark, spec, given, target)
    assert caught.value.span == ("1", "3")
    sync_table(spark, spec, given.where("k <> 4"), target)
    with pytest.raises(ConstraintError) as caught:
        sync_table(spark, spec, given, target)
    assert caught.value.span == ("1", "3") and sorted(caught.value.rows) == [(2,), (4,)]
    memory = spark.createDataFrame([(9, "a", 1)], SCHEMA)
    with pytest.raises(ConstraintError) as caught:
        sync_table(spark, spec, memory, target)
    assert caught.value.span is None


def test_spec_from_the_catalogue(spark):
    spark.sql("CREATE TABLE keyed (b STRING, a INT, note STRING) USING parquet")
    try:
        with pytest.raises(ValueError, match="no primary key"):
            catalogue.spec_of(spark, "keyed")
        with pytest.raises(ValueError, match="columns not in"):
            catalogue.declare_key(spark, "keyed", ["zz"])
        with pytest.raises(ValueError, match="needs a key"):
            catalogue.declare_key(spark, "keyed", [])
        catalogue.declare_key(spark, "keyed", ["a", "b"], [["note"]])
        spec = catalogue.spec_of(spark, "keyed")
        assert (spec.name, spec.key, spec.unique_keys) == ("keyed", ("a", "b"), (("note",),))
        columns = catalogue.columns_of(spark, "keyed")
        assert rows_of(columns) == sorted(
            [("b", 1, "string", 2), ("a", 2, "int", 1), ("note", 3, "string", None)], key=repr
        )
        assert catalogue.key_list(columns).first().key_columns == "a, b"
        spark.sql("INSERT INTO keyed VALUES ('x', 1, 'n'), (NULL, 2, NULL)")
        found = catalogue.key_columns(spark, {"shown": "keyed"}).orderBy("key_ordinal").collect()
        assert [(r["table"], r["column"], r.n_rows, r.n_nulls) for r in found] == [
            ("shown", "a", 2, 0), ("shown", "b", 2, 1),
        ]
        with pytest.raises(ValueError, match="does not exist"):
            catalogue.columns_of(spark, "no_such_table")
    finally:
        spark.sql("DROP TABLE keyed")


def test_footers_answer_counts_and_maxima(spark):
    own = footer_session(spark)
    orders = own.read.parquet(f"{SF01}/orders.parquet")
    high = keys.key_high_water(orders, ["o_orderkey"])
    counts = inspect.table_counts({"orders": orders})
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (high, counts)]
    assert "PushedAggregation: [MAX(o_orderkey)]" in plans[0]
    assert "PushedAggregation: [COUNT(*)]" in plans[1]
    plain = spark.read.parquet(f"{SF01}/orders.parquet")
    assert rows_of(high) == rows_of(keys.key_high_water(plain, ["o_orderkey"]))
    assert rows_of(counts) == [("orders", plain.count())]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
