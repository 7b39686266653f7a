"""References: orphans, parents before children, runs that are started again."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablesync import (
    ConstraintError,
    Reference,
    SyncOptions,
    TableJob,
    TableSpec,
    link_sync,
    retried,
    run_all,
    sync_table,
)
from tablesync.operators.references import levels, missing_parents, orphan_rows
from tablesync.plans.job import STEPS

PARENT = TableSpec("parent", ("a", "b"))
CHILD = TableSpec("child", ("k",), references=[Reference(("pa", "pb"), "parent", ("a", "b"))])
P, C = "a int, b string, v int", "k int, pa int, pb string"


def test_orphans(spark):
    parent = spark.createDataFrame([(1, "x", 0), (2, "y", 0), (None, "x", 0)], P)
    rows = [(1, 1, "x"), (2, 1, "y"), (3, None, "x"), (4, 2, None), (5, 9, "q"), (6, 9, "q"), (7, 2, "y")]
    child = spark.createDataFrame(rows, C)
    assert rows_of(orphan_rows(child, parent, ("pa", "pb"), ("a", "b"))) == [(2, 1, "y"), (5, 9, "q"), (6, 9, "q")]
    assert rows_of(missing_parents(child, parent, ("pa", "pb"), ("a", "b"))) == [(1, "y", 1), (9, "q", 2)]
    assert rows_of(orphan_rows(child.limit(0), parent, ("pa", "pb"), ("a", "b"))) == []
    assert orphan_rows(child, parent.limit(0), ("pa", "pb"), ("a", "b")).count() == 5
    # columns of one name on both sides
    assert rows_of(orphan_rows(child.toDF("k", "a", "b"), parent, ("a", "b"), ("a", "b"))) == [
        (2, 1, "y"), (5, 9, "q"), (6, 9, "q"),
    ]


def test_values_are_counted_before_they_are_exchanged(spark):
    child = spark.range(1000).select(F.lit(7).cast("long").alias("p"))
    found = missing_parents(child, spark.range(3), ("p",), ("id",))
    assert "partial_count" in found._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found) == [(7, 1000)]


def test_levels():
    assert levels({"c": ["b", "a"], "b": ["a", "elsewhere"], "a": ["a"], "d": []}) == [["a", "d"], ["b"], ["c"]]
    assert levels({}) == []
    with pytest.raises(ValueError, match="cycle"):
        levels({"a": ["b"], "b": ["c"], "c": ["a"], "d": []})


@pytest.mark.parametrize("parallel", [1, 3])
def test_child_fails_parent_is_published(spark, new_target, parallel):
    targets = {s.name: new_target(s.name) for s in (PARENT, CHILD)}
    targets["parent"].create(PARENT, spark.createDataFrame([], P).schema)
    targets["child"].create(CHILD, spark.createDataFrame([], C).schema)

    def jobs(child_rows):
        return [
            TableJob(CHILD, lambda: spark.createDataFrame(child_rows, C), targets["child"]),
            TableJob(PARENT, lambda: spark.createDataFrame([(1, "x", 0), (2, "y", 0)], P), targets["parent"]),
        ]

    result = run_all(spark, jobs([(1, 1, "x"), (2, 3, "z")]), parallel)
    assert [r.table for r in result.reports] == ["child", "parent"] and result.exit_code == 1
    assert "reference" in result.reports[0].error and "(2,)" in result.reports[0].error
    assert targets["parent"].load().count() == 2 and targets["child"].load().count() == 0
    # the parents are there now, also for a table synced alone
    assert run_all(spark, jobs([(1, 1, "x"), (2, 2, "y")]), parallel).exit_code == 0
    more = spark.createDataFrame([(3, None, "q"), (1, 2, "y")], C)
    assert sync_table(spark, CHILD, more, targets["child"], parents=targets).affected_rows == 2
    with pytest.raises(ConstraintError, match="reference"):
        sync_table(spark, CHILD, spark.createDataFrame([(1, 5, "y")], C), targets["child"], parents=targets)
    with pytest.raises(ValueError, match="no target"):
        sync_table(spark, CHILD, more, targets["child"])
    assert rows_of(targets["child"].load()) == [(1, 2, "y"), (2, 2, "y"), (3, None, "q")]


def test_a_table_that_refers_to_itself(spark, new_target):
    spec = TableSpec("staff", ("id",), references=[Reference("boss", "staff", "id")])
    target = new_target("staff")
    link_sync(spark, TableSpec("staff", ("id",)), spark.createDataFrame([(1, None)], "id int, boss int"), target)
    rows = spark.createDataFrame([(1, None), (2, 3), (3, 1)], "id int, boss int")
    assert sync_table(spark, spec, rows, target).affected_rows == 2
    with pytest.raises(ConstraintError):
        sync_table(spark, spec, spark.createDataFrame([(4, 8)], "id int, boss int"), target)


def test_reference_needs_as_many_columns():
    with pytest.raises(ValueError, match="as many columns"):
        Reference(("a", "b"), "parent", ("a",))


@pytest.mark.parametrize("broken", STEPS)
def test_a_run_that_breaks_and_is_started_again(spark, new_target, broken):
    spec, schema = TableSpec("t", "k", identity=("k",)), "k bigint, v string, ts bigint"
    options = SyncOptions(incremental_col="ts", prune=True, allow_prune=True, sync_sequence=True)
    old = [(1, "a", 1), (2, "b", 1), (3, "c", 1)]
    new = [(1, "a", 1), (2, "B", 2), (4, "d", 3)]
    clean, shaken = new_target("clean"), new_target("shaken")
    for target in (clean, shaken):
        link_sync(spark, spec, spark.createDataFrame(old, schema), target)
    sync_table(spark, spec, spark.createDataFrame(new, schema), clean, options)
    calls, failures = [], [OSError("lost")]

    def step(name):
        calls.append(name)
        if name == broken and failures:
            raise failures.pop()

    def run():
        return sync_table(spark, spec, spark.createDataFrame(new, schema), shaken, options, on_step=step)

    report = retried(run, attempts=2)
    assert not failures and calls[-1] == STEPS[-1]
    assert rows_of(shaken.load()) == rows_of(clean.load()) == sorted(new)
    assert shaken.pointer().watermark == clean.pointer().watermark
    assert report.sequences == {"k": 4}
    before = shaken.pointer().version
    assert retried(run, attempts=1).version == before  # nothing is left to do


def test_what_would_fail_again_is_raised_at_once(spark, new_target):
    target = new_target()
    tried = []

    def run():
        tried.append(1)
        return sync_table(spark, TableSpec("t", "k"), spark.createDataFrame([(1,)], "k int"), target)

    with pytest.raises(ValueError, match="does not exist"):
        retried(run, attempts=3)
    assert len(tried) == 1
    lost = []

    def always():
        lost.append(1)
        raise OSError("lost")

    with pytest.raises(OSError):
        retried(always, attempts=3)
    assert len(lost) == 3
