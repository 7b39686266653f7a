"""The physical plans the operators are meant to get."""

from __future__ import annotations

import re

import pytest
from conftest import SF01, rows_of
from pyspark.sql import functions as F

from tablesync import SyncOptions, TableSpec, link_sync, sync_table
from tablesync.operators import classify as cl
from tablesync.operators import duplicates, keys, merge, prune
from tablesync.operators.insert_only import accepted_rows, without_clash
from tablesync.operators.watermark import Watermark, read_since, watermark_max
from tablesync.queries.inputs import table
from tablesync.queries.registry import ORDERS
from tablesync.sources.bucketed import BucketedTarget
from tablesync.sources.snapshot import bucket_of

SINCE = Watermark("o_orderdate", "timestamp_ntz", "1999-01-01 00:00:00")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, word):
    return len(re.findall(word, plan(df)))


@pytest.fixture
def large(spark):
    """Plan as for tables no side of which may be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(watermark_max(read_since(table(spark, SF01, "orders"), "o_orderdate", SINCE), "o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    text = plan(keys.key_high_water(table(spark, SF01, "orders"), ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_one_exchange_per_side(large):
    s, t = table(large, SF01, "orders"), table(large, SF01, "orders_tgt")
    for df in (merge.upsert(s, t, ("o_orderkey",)), merge.mirror(s, t, ("o_orderkey",))):
        assert count(df, r"Exchange hashpartitioning") == 2
        assert count(df, "SortMergeJoin") == 1
        assert count(df, "PythonUDF|ArrowEval|MapInPandas") == 0


def test_prune_reads_keys_only(large):
    s, t = table(large, SF01, "orders"), table(large, SF01, "orders")
    df = prune.prune_keys(t, s, ("o_orderkey",))
    assert plan(df).count("ReadSchema: struct<o_orderkey:bigint>") == 2
    assert count(df, r"Exchange hashpartitioning") == 2  # distinct and join share theirs


def test_prune_deals_keys_to_all_tasks(large):
    """Adaptive execution merges tasks by bytes, and keys are few bytes but many rows."""
    s, t = table(large, SF01, "orders"), table(large, SF01, "orders_tgt")
    tasks = int(large.conf.get("spark.sql.shuffle.partitions"))
    assert prune.prune_keys(t, s, ("o_orderkey",)).rdd.getNumPartitions() == tasks
    both = merge.upsert_keys(s.select("o_orderkey"), t.select("o_orderkey"), ("o_orderkey",))
    assert both.rdd.getNumPartitions() >= tasks


def test_insert_only_moves_whole_rows_once(large, scratch, monkeypatch):
    """With several keys, only the sort moves columns that are no keys."""
    plans, write = {}, scratch.write

    def watched(df, label):
        plans.setdefault(label, plan(df))
        return write(df, label)

    monkeypatch.setattr(scratch, "write", watched)
    schema = "k long, u double, w long, wide string"
    source = large.createDataFrame(
        [(i, -0.0 if i == 7 else float(i % 50), None if i % 3 else i % 40, "wide") for i in range(200)], schema
    )
    target = large.createDataFrame([(3, 0.0, None), (4, 0.0, None), (4, None, 9)], "k long, u double, w long")
    got = accepted_rows(source, target, ("k",), scratch, (("u",), ("w",)), ("k",))
    taken, want = [{3, 4}, {0.0}, {9}], []
    for row in source.orderBy("k").collect():
        values = (row.k, row.u, row.w)
        if not any(v in seen for v, seen in zip(values, taken) if v is not None):
            want.append(row.k)
            for v, seen in zip(values, taken):
                seen.add(v)
    assert sorted(r.k for r in got.collect()) == want
    assert len(re.findall(r"Exchange ", plans["candidates"])) == 1
    assert all("wide" not in text for label, text in plans.items() if label != "candidates")


def test_changed_rows_prunes_columns(large):
    s, t = table(large, SF01, "orders"), table(large, SF01, "orders_tgt")
    df = cl.changed_rows(s.select("o_orderkey", "o_totalprice"), t, ("o_orderkey",))
    assert "o_custkey" not in plan(df)


def test_small_increment_leaves_the_target_in_place(spark):
    """A small part is broadcast at run time; the target side has no exchange."""
    s, t = table(spark, SF01, "orders"), table(spark, SF01, "orders_tgt")
    part = read_since(s, "o_orderdate", Watermark("o_orderdate", "timestamp_ntz", "2001-07-30"))
    df = cl.classify_part(part, t, ("o_orderkey",))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_small_insert_only_source_leaves_the_target_in_place(spark):
    s, t = table(spark, SF01, "customer_src"), table(spark, SF01, "customer")
    few = s.where("c_nationkey = 3")
    df = without_clash(few, t, ("c_name",), narrow=True)
    expected = without_clash(few, t, ("c_name",))
    assert rows_of(df) == rows_of(expected)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin [c_name" in final and "LeftSemi, BuildRight" in final


def test_write_layout_needs_no_extra_exchange(large, tmp_path):
    """Each task of a merge holds rows of one bucket, so n tasks write n files."""
    t = table(large, SF01, "orders_tgt")
    changes = merge.change_set(table(large, SF01, "orders"), t, ("o_orderkey",))
    rows = merge.apply_changes(t, changes, ("o_orderkey",), 16)
    tagged = rows.withColumn("bucket", bucket_of(("o_orderkey",), 4))
    spread = tagged.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("bucket").alias("n"))
    assert {r.n for r in spread.collect()} == {1}
    tagged.write.partitionBy("bucket").parquet(str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("bucket=*/*.parquet"))
    assert len(files) == 16


def test_repeated_keys_combine_before_the_exchange(large):
    df = duplicates.dedup(table(large, SF01, "lineitem"), ("l_orderkey", "l_linenumber"))
    assert "partial_max" in plan(df) and "Window" not in plan(df)
    df = duplicates.duplicate_keys(table(large, SF01, "lineitem"), ("l_orderkey",))
    assert "partial_count" in plan(df)


def test_null_values_are_spread_over_tasks(large):
    """Rows with a NULL unique value would otherwise all meet in one task."""
    rows = large.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("u")
    )
    taken = large.range(30).select(F.col("id").alias("u"))
    large.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = without_clash(rows, taken, ("u",))
        assert re.search(r"hashpartitioning\(u#\d+L, __salt", plan(left))
        sizes = [
            r["count"]
            for r in left.where("u IS NULL").groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        large.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 2666 and max(sizes) < 1000
    assert left.count() == 4000 - 10
    assert left.columns == rows.columns and rows_of(left.where("u = 0")) == []


def test_bucketed_target_stays_in_place(large, tmp_path):
    """A whole run exchanges its source once; the stored side is read as it lies."""
    large.conf.set("spark.sql.shuffle.partitions", "8")
    target = BucketedTarget(large, str(tmp_path / "t"), buckets=8)
    link_sync(large, ORDERS, table(large, SF01, "orders_tgt"), target)
    source, key = table(large, SF01, "orders"), list(ORDERS.key)
    watched = duplicates.first_two(source, key, "__nth")
    for rows in (source, watched):
        df = merge.change_set(rows, target.rows(), key, prune=True)
        assert count(df, r"Exchange hashpartitioning") == 1
    assert rows_of(merge.change_set(source, target.rows(), key)) == rows_of(
        merge.change_set(source, table(large, SF01, "orders_tgt"), key)
    )
    # a second base folder, and one again
    sync_table(large, ORDERS, source, target)
    assert len(target.pointer().live) == 2
    expected = rows_of(merge.upsert(source, table(large, SF01, "orders_tgt"), key))
    assert rows_of(target.load()) == expected
    target.compact()
    assert count(merge.change_set(source, target.rows(), key), r"Exchange hashpartitioning") == 1
    assert len(target.expire(keep=1)) >= 2 and rows_of(target.load()) == expected
    assert len([t for t in large.catalog.listTables() if t.name.startswith("tablesync_")]) == 1


def test_bucketed_target_gains_columns(spark, tmp_path):
    target = BucketedTarget(spark, str(tmp_path / "t"), buckets=4)
    spec = TableSpec("t", ("a", "b"))
    link_sync(spark, spec, spark.createDataFrame([(1, "x", 1)], "a int, b string, v int"), target)
    wide = spark.createDataFrame([(1, "x", 1, None), (2, "y", 2, "n")], "a int, b string, v int, w string")
    report = sync_table(spark, spec, wide, target, SyncOptions(add_columns=True))
    assert report.affected_rows == 1 and rows_of(target.load()) == [(1, "x", 1, None), (2, "y", 2, "n")]
    later = spark.newSession()  # another session registers the folders for itself
    assert BucketedTarget(later, target.root).load().count() == 2
    part = spark.createDataFrame([(2, "y", 3, "n")], wide.schema)
    sync_table(spark, spec, part, target, SyncOptions(incremental_col="v"))
    assert (2, "y", 3, "n") in rows_of(target.load())
