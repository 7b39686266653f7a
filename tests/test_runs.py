"""Whole runs against a stored target: state rules, failures, reports, streams."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablesync import (
    ConstraintError,
    SyncOptions,
    TableJob,
    TableSpec,
    link_sync,
    run_all,
    run_report,
    sync_table,
)
from tablesync.operators.schema import schema_diff, schema_plan
from tablesync.operators.watermark import Watermark
from tablesync.sources.readers import reads_alike
from tablesync.sources.snapshot import Pointer, SnapshotTarget
from tablesync.sources.state import StateFile
from tablesync.streaming.runner import apply_batch, read_stream, run_available

SPEC = TableSpec("t", "k", identity=("k",))
SCHEMA = "k bigint, v string, ts bigint"
MIRROR = SyncOptions(prune=True, allow_prune=True)
SINCE = SyncOptions(incremental_col="ts")


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def filled(spark, target, rows, spec=SPEC, schema=SCHEMA):
    link_sync(spark, spec, df(spark, rows, schema), target)
    return target


def test_upsert_counts_and_rerun(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 1), (9, "z", 1)])
    source = df(spark, [(1, "a", 1), (2, None, 1), (3, "c", 1)])
    report = sync_table(spark, SPEC, source, target)
    assert (report.read_rows, report.affected_rows, report.deleted_rows) == (3, 2, 0)
    assert rows_of(target.load()) == [(1, "a", 1), (2, None, 1), (3, "c", 1), (9, "z", 1)]
    version = target.pointer().version
    again = sync_table(spark, SPEC, source, target)
    assert (again.affected_rows, again.version) == (0, version)
    assert target.pointer().version == version  # nothing was written


def test_mirror_and_empty_source(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 1)])
    report = sync_table(spark, SPEC, df(spark, [(2, "B", 1)]), target, MIRROR)
    assert (report.affected_rows, report.deleted_rows) == (1, 1)
    empty = df(spark, [])
    assert sync_table(spark, SPEC, empty, target).affected_rows == 0
    assert target.load().count() == 1
    high = SyncOptions(prune=True, allow_prune=True, sync_sequence=True)
    report = sync_table(spark, SPEC, empty, target, high)
    assert report.deleted_rows == 1 and target.load().count() == 0
    assert report.sequences == {"k": 1} and report.sequence_synced


def test_prune_gate_and_missing_target(spark, new_target):
    target = new_target()
    with pytest.raises(ValueError, match="does not exist"):
        sync_table(spark, SPEC, df(spark, []), target)
    filled(spark, target, [(1, "a", 1)])
    with pytest.raises(PermissionError):
        sync_table(spark, SPEC, df(spark, []), target, SyncOptions(prune=True))
    assert target.load().count() == 1


def test_incremental_state_rules(spark, new_target):
    target = filled(spark, new_target(), [])
    run = lambda rows, **o: sync_table(
        spark, SPEC, df(spark, rows), target, SyncOptions(incremental_col="ts", **o)
    )
    # First run reads everything, NULL watermarks included.
    first = run([(1, "a", 10), (2, "b", None), (3, "c", 20)])
    assert (first.mode, first.read_rows, first.watermark) == ("incremental", 3, "20")
    # The bound is inclusive; NULL and lower rows are not read again.
    second = run([(1, "changed", 10), (2, "changed", None), (3, "C", 20), (4, "d", 20)])
    assert (second.read_rows, second.affected_rows) == (2, 2)
    assert (1, "a", 10) in rows_of(target.load())
    # No rows: the watermark stays.
    assert run([(1, "a", 5)]).watermark == "20"
    assert target.pointer().watermark == Watermark("ts", "bigint", "20")
    # A plain run neither reads nor writes it.
    sync_table(spark, SPEC, df(spark, [(1, "full", 99)]), target)
    assert target.pointer().watermark.value == "20"
    # A refresh ignores it and may lower it.
    assert run([(1, "r", 7)], full_refresh=True).watermark == "7"
    # A refresh over nothing keeps the saved value.
    run([], full_refresh=True)
    assert target.pointer().watermark.value == "7"
    # Another column counts as a first run and replaces the entry.
    other = sync_table(
        spark, SPEC, df(spark, [(1, "x", 1)]), target, SyncOptions(incremental_col="v")
    )
    assert other.read_rows == 1
    assert target.pointer().watermark == Watermark("v", "string", "x")
    with pytest.raises(ValueError):
        sync_table(spark, SPEC, df(spark, []), target, SyncOptions(incremental_col="nope"))


def test_incremental_prune_uses_every_source_key(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    target.commit(target.pointer().next_with(watermark=Watermark("ts", "bigint", "3")))
    options = SyncOptions(incremental_col="ts", prune=True, allow_prune=True)
    report = sync_table(
        spark, SPEC, df(spark, [(1, "late", 1), (3, "C", 3), (4, "d", 4)]), target, options
    )
    assert (report.read_rows, report.affected_rows, report.deleted_rows) == (2, 2, 1)
    assert rows_of(target.load()) == [(1, "a", 1), (3, "C", 3), (4, "d", 4)]


def test_insert_only_advances_the_watermark(spark, new_target):
    spec = TableSpec("t", "k", unique_keys=(("v",),))
    target = filled(spark, new_target(), [(1, "a", 1)], spec)
    options = SyncOptions(incremental_col="ts", insert_only=True)
    source = df(spark, [(1, "new", 5), (2, "a", 6), (3, "c", 7), (4, "c", 8), (5, None, 9)])
    report = sync_table(spark, spec, source, target, options)
    assert (report.read_rows, report.affected_rows, report.watermark) == (5, 2, "9")
    assert rows_of(target.load()) == [(1, "a", 1), (3, "c", 7), (5, None, 9)]
    # Prune comes first, so a re-keyed row gets in.
    pruned = SyncOptions(insert_only=True, prune=True, allow_prune=True)
    report = sync_table(spark, spec, df(spark, [(10, "a", 1), (3, "x", 1)]), target, pruned)
    assert (report.affected_rows, report.deleted_rows) == (1, 2)
    assert rows_of(target.load()) == [(10, "a", 1), (3, "c", 7)]


def test_timestamp_watermarks_survive_the_time_zone(spark, new_target):
    spec = TableSpec("t", "k")
    moment = dt.datetime(2024, 3, 1, 12, 0, 0, 123456)
    source = spark.createDataFrame([(1, moment)], "k int, ts timestamp")
    target = new_target()
    target.create(spec, source.schema)
    sync_table(spark, spec, source, target, SINCE)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert sync_table(spark, spec, source, target, SINCE).read_rows == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_constraints_publish_nothing(spark, new_target):
    spec = TableSpec("t", "k", unique_keys=(("v",),))
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 1)], spec)
    before = target.pointer()
    with pytest.raises(ConstraintError, match="unique"):
        sync_table(spark, spec, df(spark, [(3, "a", 9)]), target, SINCE)
    with pytest.raises(ConstraintError, match="not null"):
        sync_table(spark, spec, df(spark, [(None, "c", 9)]), target, SINCE)
    assert target.pointer() == before
    # Re-keyed: fails without prune, fine with it.
    sync_table(spark, spec, df(spark, [(3, "a", 1), (2, "b", 1)]), target, MIRROR)
    assert rows_of(target.load()) == [(2, "b", 1), (3, "a", 1)]
    # Swapped values: fine at the end, refused row by row.
    swap = df(spark, [(2, "a", 1), (3, "b", 1)])
    with pytest.raises(ConstraintError):
        sync_table(spark, spec, swap, target, SyncOptions(unique_check="strict"))
    assert sync_table(spark, spec, swap, target).affected_rows == 2


def test_repeated_source_keys(spark, new_target):
    spec = TableSpec("t", "k", order_by=("ts",))
    rows = [(1, "b", 2), (1, "a", 1), (1, "c", 3), (1, "c", 4), (2, "x", 1)]
    for policy, value, affected in (("last", (1, "c", 4), 5), ("first", (1, "a", 1), 2)):
        target = filled(spark, new_target(policy), [], spec)
        report = sync_table(
            spark, spec, df(spark, rows), target, SyncOptions(on_duplicate=policy)
        )
        assert rows_of(target.load()) == [value, (2, "x", 1)]
        assert (report.read_rows, report.affected_rows) == (5, affected)
    with pytest.raises(ConstraintError, match="one row per key"):
        sync_table(spark, spec, df(spark, rows), target, SyncOptions(on_duplicate="error"))
    # Against existing rows: (1) is written four times, (2) not at all.
    target = filled(spark, new_target("again"), [(1, "q", 0), (2, "x", 1)], spec)
    assert sync_table(spark, spec, df(spark, rows), target).affected_rows == 4


def test_failure_before_publishing_keeps_everything(spark, new_target, monkeypatch):
    target = filled(spark, new_target(), [(1, "a", 1)])
    sync_table(spark, SPEC, df(spark, [(1, "a", 1)]), target, SINCE)
    before, rows = target.pointer(), rows_of(target.load())

    def broken(pointer):
        raise OSError("lost")

    monkeypatch.setattr(target, "commit", broken)
    with pytest.raises(OSError):
        sync_table(spark, SPEC, df(spark, [(2, "b", 8)]), target, SINCE)
    monkeypatch.undo()
    assert target.pointer() == before and rows_of(target.load()) == rows
    # The next run is not disturbed by the leftovers of the failed one.
    sync_table(spark, SPEC, df(spark, [(3, "c", 9)]), target, SINCE)
    assert rows_of(target.load()) == [(1, "a", 1), (3, "c", 9)]


def test_two_writers_of_one_version(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1)])
    staged = target.pointer().next_with()
    target.commit(staged)
    with pytest.raises(Exception, match="exist"):
        target.commit(staged)


def test_a_losing_writer_does_not_harm_the_winner(spark, new_target):
    target = filled(spark, new_target(buckets=1), [(1, "a", 1)])
    slow = target.using(spark)
    seen = slow.pointer()
    sync_table(spark, SPEC, df(spark, [(2, "b", 1)]), target)
    slow.pointer = lambda: seen  # started before the other run published
    with pytest.raises(Exception, match="exist"):
        sync_table(spark, SPEC, df(spark, [(3, "c", 1)]), slow)
    assert rows_of(target.load()) == [(1, "a", 1), (2, "b", 1)]


def test_old_version_stays_readable_then_expires(spark, new_target):
    target = filled(spark, new_target(buckets=1), [(1, "a", 1)])
    old = target.pointer()
    reader = target.load(old)
    for i in range(3):
        sync_table(spark, SPEC, df(spark, [(1, f"v{i}", 1)]), target)
    assert rows_of(reader) == [(1, "a", 1)]
    assert target.expire(keep=1) == []  # deltas are merged over all folders before them
    target.compact()
    assert [int(folder[:12]) for folder in target.expire(keep=1)] == [1, 2, 3, 4]
    assert rows_of(target.load()) == [(1, "v2", 1)]


def stored_bytes(target):
    files = Path(target.root, "data").rglob("*.parquet")
    return sum(f.stat().st_size for f in files)


def test_scattered_updates_write_what_changed(spark, new_target):
    rows = [(i, f"value {i * 7919}", i) for i in range(20_000)]
    target = filled(spark, new_target(buckets=16), rows)
    before, size = target.pointer(), stored_bytes(target)
    changed = [(i, "new", i) for i in range(0, 20_000, 100)]
    assert sync_table(spark, SPEC, df(spark, changed), target).affected_rows == 200
    after = target.pointer()
    assert after.live == before.live and len(after.deltas) == 1
    assert stored_bytes(target) - size < size / 10
    assert target.load().where("v = 'new'").count() == 200 and target.load().count() == 20_000
    assert Pointer.from_json(after.to_json()) == after


def test_deltas_merge_by_version_and_compact(spark, new_target):
    """Update, prune, bring back, update again; reading and compacting give the same rows."""
    target = filled(spark, new_target(buckets=2), [(i, "a", 1) for i in range(20)])
    known = {i: ("a", 1) for i in range(20)}
    prune = SyncOptions(prune=True, allow_prune=True)
    steps = [
        ({3: ("b", 1), 4: ("b", 1)}, set()),
        ({}, {3, 5}),
        ({3: ("again", 2), 50: ("new", 2)}, set()),
        ({3: ("last", 3)}, {50}),
        ({50: ("back", 4)}, set()),
    ]
    for change, gone in steps:
        known = {k: v for k, v in (known | change).items() if k not in gone}
        sync_table(spark, SPEC, df(spark, [(k, *v) for k, v in known.items()]), target, prune)
        want = sorted((k, *v) for k, v in known.items())
        assert rows_of(target.load()) == sorted(want, key=repr)
    assert len(target.pointer().deltas) == len(steps)
    part = target.load(buckets=[0])
    assert 0 < part.count() < len(known)
    old = target.pointer()
    assert target.compact() == old.version + 1
    after = target.pointer()
    assert after.deltas == () and len(after.live) == 1
    assert rows_of(target.load()) == sorted(want, key=repr)
    assert target.compact() == after.version  # nothing left to do
    assert rows_of(target.load(old)) == sorted(want, key=repr)
    target.expire(keep=1)
    assert rows_of(target.load()) == sorted(want, key=repr)


def test_new_rows_are_appended_by_all_write_tasks(spark, tmp_path):
    target = SnapshotTarget(spark, str(tmp_path / "wide"), buckets=2, files_per_bucket=8)
    filled(spark, target, [(-1, "a", 1)])
    rows = [(i, "new", 1) for i in range(2000)]
    before = set(Path(target.root, "data").rglob("*.parquet"))
    report = sync_table(spark, SPEC, df(spark, rows), target, SyncOptions(insert_only=True))
    assert report.affected_rows == 2000 and target.pointer().deltas == ()
    files = set(Path(target.root, "data").rglob("*.parquet")) - before
    assert len(files) == 16
    assert target.load().count() == 2001


def test_a_source_that_changes_between_reads(spark, new_target, tmp_path):
    """What is not known to read alike is read once, so checks and merge see the same rows."""
    counter = tmp_path / "reads"
    counter.mkdir()

    def read(batches):
        for batch in batches:
            if len(batch):
                (counter / uuid.uuid4().hex).touch()
            yield batch

    live = df(spark, [(1, "a", 1), (2, "b", 2)]).coalesce(1)
    live = live.mapInPandas(read, live.schema)
    target = filled(spark, new_target(), [(1, "x", 1)])
    assert sync_table(spark, SPEC, live, target).affected_rows == 2
    assert len(list(counter.iterdir())) == 1
    assert reads_alike(df(spark, [(1, "a", 1)])) and not reads_alike(live)
    assert not reads_alike(spark.range(9).withColumn("r", F.rand()))


def test_a_source_without_a_unique_column(spark, new_target):
    spec = TableSpec("t", "k", unique_keys=(("v",),))
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 2)], spec)
    part = df(spark, [(1, "", 9), (3, "", 3)]).drop("v")
    assert sync_table(spark, spec, part, target).affected_rows == 2
    assert rows_of(target.load()) == [(1, "a", 9), (2, "b", 2), (3, None, 3)]
    more = df(spark, [(3, "", 7), (4, "", 4)]).drop("v")
    report = sync_table(spark, spec, more, target, SyncOptions(insert_only=True))
    assert report.affected_rows == 1
    assert (4, None, 4) in rows_of(target.load())
    fresh = filled(spark, new_target("fresh"), [], spec)
    assert sync_table(spark, spec, part, fresh).affected_rows == 2


def test_columns_that_differ_in_case_are_refused_at_once(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1)])
    wide = df(spark, [(1, "a", 1)]).withColumnRenamed("v", "V")
    with pytest.raises(ValueError, match="case"):
        sync_table(spark, SPEC, wide, target, SyncOptions(add_columns=True))


def test_stored_high_water(spark, new_target):
    spec = TableSpec("t", "k", identity=("k",))
    target = filled(spark, new_target(), [(5, "a", 1)], spec)
    high = SyncOptions(sync_sequence=True)
    assert sync_table(spark, spec, df(spark, [(9, "b", 1)]), target, high).sequences == {"k": 9}
    assert target.pointer().high_water == {"k": 9}
    assert sync_table(spark, spec, df(spark, [(7, "c", 1)]), target, high).sequences == {"k": 9}
    assert sync_table(spark, spec, df(spark, [(7, "d", 1)]), target, high).sequences == {"k": 9}
    # a run that does not keep it makes the next one look again
    sync_table(spark, spec, df(spark, [(20, "e", 1)]), target)
    assert target.pointer().high_water is None
    assert sync_table(spark, spec, df(spark, [(1, "f", 1)]), target, high).sequences == {"k": 20}
    prune = SyncOptions(sync_sequence=True, prune=True, allow_prune=True)
    assert sync_table(spark, spec, df(spark, [(7, "d", 1)]), target, prune).sequences == {"k": 7}


def test_columns_with_everyday_names(spark, new_target):
    """Names the operators could have used themselves: op, n, bucket, count."""
    spec = TableSpec("t", ("n", "bucket"), unique_keys=(("count",),))
    schema = "n int, bucket string, op string, count int, row int"
    rows = [(1, "x", "insert", 1, 1), (1, "y", "keep", 2, 1), (2, "x", "prune", None, 1)]
    target = filled(spark, new_target(), rows, spec, schema)
    source = df(spark, [(1, "x", "update", 1, 1), (3, "z", "new", 5, 1)], schema)
    report = sync_table(spark, spec, source, target, MIRROR)
    assert (report.affected_rows, report.deleted_rows) == (2, 2)
    assert rows_of(target.load()) == [(1, "x", "update", 1, 1), (3, "z", "new", 5, 1)]
    more = df(spark, [(4, "a", "o", 5, 1), (5, "b", "o", 6, 1), (5, "b", "o", 7, 2)], schema)
    report = sync_table(spark, spec, more, target, SyncOptions(insert_only=True))
    assert report.affected_rows == 1
    repeated = df(spark, [(9, "a", "o", 8, 1), (9, "a", "p", 9, 2)], schema)
    assert sync_table(spark, spec, repeated, target).affected_rows == 2
    with pytest.raises(ConstraintError):
        sync_table(spark, spec, df(spark, [(8, "a", "o", 1, 1)], schema), target)


def test_columns_with_dots_and_backticks(spark, new_target):
    schema = "`a.k` bigint, `v``x` string, `50%` bigint"
    spec = TableSpec("t", "a.k", unique_keys=(("v`x",),), identity=("a.k",))
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 2)], spec, schema)
    source = df(spark, [(2, "B", 2), (3, "c", 3)], schema).withColumn("n.new", F.lit(7))
    options = SyncOptions(prune=True, allow_prune=True, sync_sequence=True, add_columns=True)
    report = sync_table(spark, spec, source, target, options)
    assert (report.affected_rows, report.deleted_rows, report.sequences) == (2, 1, {"a.k": 3})
    assert report.added_columns == {"n.new": "int"}
    assert target.load().columns == ["a.k", "v`x", "50%", "n.new"]
    assert rows_of(target.load()) == [(2, "B", 2, 7), (3, "c", 3, 7)]
    rows = df(spark, [(2, "zz", 0), (4, "B", 0), (5, "d", 5)], schema)
    assert sync_table(spark, spec, rows, target, SyncOptions(insert_only=True)).affected_rows == 1
    with pytest.raises(ConstraintError):
        sync_table(spark, spec, df(spark, [(9, "c", 1)], schema), target)
    batch = df(spark, [(6, "f", 6)], schema)
    assert apply_batch(spec, target, batch, "s", 0).affected_rows == 1
    target.compact()
    assert target.load().count() == 4


def test_schema_evolution(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 1)])
    spec = TableSpec("t", "k", declared_types={"d": "DECIMAL(10,2)", "f": "BOOLEAN"})
    source = df(
        spark, [(1, "a", "1.5", "yes"), (2, "b", None, "off")], "k bigint, v string, d string, f string"
    )
    with pytest.raises(ValueError, match="missing in the target"):
        sync_table(spark, spec, source, target)
    before = target.pointer()
    plan = sync_table(spark, spec, source, target, SyncOptions(add_columns=True, dry_run=True))
    assert plan.dry_run and plan.added_columns == {"d": "decimal(10,2)", "f": "boolean"}
    # Missing columns are no error in a dry run, and nothing happens.
    plain = sync_table(spark, spec, source, target, SyncOptions(dry_run=True))
    assert plain.dry_run and plain.added_columns == {} and target.pointer() == before
    report = sync_table(spark, spec, source, target, SyncOptions(add_columns=True))
    assert report.added_columns == {"d": "decimal(10,2)", "f": "boolean"}
    assert report.target_only == ("ts",) and report.affected_rows == 2
    out = {r.k: (r.v, r.ts, str(r.d), r.f) for r in target.load().collect()}
    assert out == {1: ("a", 1, "1.50", True), 2: ("b", 1, "None", False)}
    again = sync_table(spark, spec, source, target, SyncOptions(add_columns=True))
    assert again.added_columns == {} and again.affected_rows == 0


def test_added_column_is_null_until_a_full_run(spark, new_target):
    target = filled(spark, new_target(), [(1, "a", 1), (2, "b", 2)])
    target.commit(target.pointer().next_with(watermark=Watermark("ts", "bigint", "2")))
    source = df(spark, [(1, "a", 1, "x"), (2, "b", 2, "y")], SCHEMA + ", n string")
    options = SyncOptions(incremental_col="ts", add_columns=True)
    sync_table(spark, SPEC, source, target, options)
    assert rows_of(target.load()) == [(1, "a", 1, None), (2, "b", 2, "y")]
    assert sync_table(spark, SPEC, source, target).affected_rows == 1
    assert rows_of(target.load()) == [(1, "a", 1, "x"), (2, "b", 2, "y")]


def test_schema_plan_rows(spark):
    source = df(spark, [], "k bigint, a int, n date")
    target = df(spark, [], "k bigint, a string, old int")
    plan = schema_plan(spark, "t", schema_diff(source.schema, target.schema))
    assert rows_of(plan) == [
        ("t", "a", "string -> int", "retype"),
        ("t", "n", "date", "add"),
        ("t", "old", None, "target_only"),
    ]


def test_link_sync(spark, new_target):
    target = new_target()
    spec = TableSpec("t", "k", identity=("k",))
    made = link_sync(spark, spec, df(spark, [(1, "a", 1), (5, "b", 1)]), target).first()
    assert (made.created, made.affected_rows, made.pruned_rows, made.sequences) == (
        True, 2, 0, {"k": 5},
    )
    # Source-only columns are ignored, target-only columns survive, the stored key wins.
    source = df(spark, [(1, "A", 7), (6, "c", 8)], "k bigint, v string, extra int")
    other_key = TableSpec("t", "v")
    row = link_sync(spark, other_key, source, target, prune=True).first()
    assert (row.created, row.affected_rows, row.pruned_rows) == (False, 2, 1)
    assert rows_of(target.load()) == [(1, "A", 1), (6, "c", None)]
    row = link_sync(spark, spec, df(spark, [(1, "B", 1), (7, "d", 1)]), target, skip_dup=True)
    assert row.first().affected_rows == 1
    with pytest.raises(ConstraintError):
        link_sync(spark, spec, df(spark, [(8, "x", 1), (8, "y", 1)]), target)
    with pytest.raises(ValueError):
        link_sync(spark, spec, df(spark, [("x",)], "v string"), target)


def test_link_sync_ignores_repeats_of_a_bare_key(spark, new_target):
    target, spec, schema = new_target(), TableSpec("pair", ("a", "b")), "a int, b int"
    first = link_sync(spark, spec, df(spark, [(1, 1), (1, 1), (1, 2)], schema), target).first()
    assert first.affected_rows == 2
    row = link_sync(spark, spec, df(spark, [(1, 2), (3, 3), (3, 3)], schema), target, prune=True).first()
    assert (row.affected_rows, row.pruned_rows) == (1, 1)
    assert rows_of(target.load()) == [(1, 2), (3, 3)]


def test_failed_creation_leaves_no_table(spark, new_target):
    target = new_target()
    with pytest.raises(ConstraintError):
        link_sync(spark, SPEC, df(spark, [(None, "a", 1)]), target)
    assert not target.exists()


@pytest.mark.parametrize("parallel", [1, 3])
def test_run_all_isolates_failures(spark, new_target, parallel):
    good = filled(spark, new_target("good"), [])
    bad = filled(spark, new_target("bad"), [])
    last = filled(spark, new_target("last"), [])

    def broken():
        raise FileNotFoundError("no source")

    jobs = [
        TableJob(SPEC, lambda: df(spark, [(1, "a", 1)]), good, SINCE),
        TableJob(TableSpec("bad", "k"), broken, bad),
        TableJob(TableSpec("last", "k"), lambda: df(spark, [(2, "b", 1)]), last),
    ]
    result = run_all(spark, jobs, parallel)
    assert result.exit_code == 1
    rows = run_report(spark, result).collect()
    assert [(r.table, r.mode, r.affected_rows, r.error) for r in rows] == [
        ("t", "incremental", 1, None), ("bad", "full", 0, "no source"), ("last", "full", 1, None),
    ]
    assert run_all(spark, jobs[:1]).exit_code == 0
    with pytest.raises(PermissionError):
        run_all(spark, [*jobs, TableJob(SPEC, broken, good, SyncOptions(prune=True))])


def test_state_file(spark, tmp_path):
    state = StateFile(spark, str(tmp_path / "state"))
    assert state.load() == {} and state.get("t", "ts") is None
    state.set("t", Watermark("ts", "bigint", "5"))
    state.set("a.b/u", Watermark("d", "date", "2024-01-01"))
    assert state.get("t", "ts") == Watermark("ts", "bigint", "5")
    assert state.get("t", "other") is None
    state.set("t", Watermark("other", "string", "x"))
    assert state.get("t", "ts") is None and set(state.load()) == {"t", "a.b/u"}
    for broken in ("{not json", "[1]", "3"):
        (tmp_path / "state" / "t.json").write_text(broken)
        (tmp_path / "state" / ".t.json.crc").unlink(missing_ok=True)
        assert state.get("t", "ts") is None and set(state.load()) == {"a.b/u"}


def test_state_of_parallel_runs(spark, tmp_path):
    states = [StateFile(spark, str(tmp_path / "state")) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: states[i].set(f"t{i}", Watermark("ts", "bigint", str(i))), range(8)))
    assert {t: e["value"] for t, e in states[0].load().items()} == {f"t{i}": str(i) for i in range(8)}


def test_stream_batches(spark, new_target, tmp_path):
    target = filled(spark, new_target(), [])
    files, check = tmp_path / "in", str(tmp_path / "check")
    files.mkdir()

    def arrive(name, rows):
        df(spark, rows).coalesce(1).write.parquet(str(files / name))

    def run():
        stream = read_stream(spark, f"{files}/*", df(spark, []).schema)
        run_available(SPEC, stream, target, check, SINCE)

    arrive("a", [(1, "a", 1), (2, "b", 5), (2, "B", 6)])
    run()
    assert rows_of(target.load()) == [(1, "a", 1), (2, "B", 6)]
    pointer = target.pointer()
    run()
    assert target.pointer() == pointer  # nothing new
    # A late row still arrives and does not lower the watermark.
    arrive("b", [(3, "late", 2)])
    run()
    assert (3, "late", 2) in rows_of(target.load())
    assert target.pointer().watermark.value == "6" and set(target.pointer().batches.values()) == {1}


def test_stream_batch_is_applied_once(spark, new_target):
    target = filled(spark, new_target(), [])
    batch = df(spark, [(1, "a", 5)])
    assert apply_batch(SPEC, target, batch, "s", 0, SINCE).affected_rows == 1
    assert apply_batch(SPEC, target, df(spark, [(1, "again", 5)]), "s", 0, SINCE) is None
    assert rows_of(target.load()) == [(1, "a", 5)]
    late = df(spark, [(2, "late", 1), (3, "new", 5)])
    assert apply_batch(SPEC, target, late, "s", 1, SINCE, since_watermark=True).affected_rows == 1
    assert rows_of(target.load()) == [(1, "a", 5), (3, "new", 5)]
    # the same number from another stream is another batch
    assert apply_batch(SPEC, target, df(spark, [(9, "other", 5)]), "u", 0, SINCE).affected_rows == 1
    assert apply_batch(SPEC, target, df(spark, [(9, "again", 5)]), "u", 0, SINCE) is None
    assert target.pointer().batches == {"s": 1, "u": 0}


def test_streams_with_their_own_checkpoints(spark, new_target, tmp_path):
    """A second stream, and a new checkpoint over the same files, lose nothing."""
    target = filled(spark, new_target(), [])
    for name, rows in (("a", [(1, "a", 1)]), ("b", [(2, "b", 1)])):
        df(spark, rows).coalesce(1).write.parquet(str(tmp_path / name / "0"))
        stream = read_stream(spark, f"{tmp_path}/{name}/*", df(spark, []).schema)
        run_available(SPEC, stream, target, str(tmp_path / f"check-{name}"))
    assert rows_of(target.load()) == [(1, "a", 1), (2, "b", 1)]
    df(spark, [(3, "c", 1)]).coalesce(1).write.parquet(str(tmp_path / "b" / "1"))
    stream = read_stream(spark, f"{tmp_path}/b/*", df(spark, []).schema)
    run_available(SPEC, stream, target, str(tmp_path / "check-new"))
    assert target.load().count() == 3 and len(target.pointer().batches) == 3


def test_streams_refuse_what_needs_the_whole_source(spark, new_target):
    target = filled(spark, new_target(), [])
    batch = df(spark, [(1, "a", 5)])
    for options in (SyncOptions(prune=True, allow_prune=True), SyncOptions(incremental_col="ts", full_refresh=True)):
        with pytest.raises(ValueError, match="whole source"):
            apply_batch(SPEC, target, batch, "s", 0, options)
