"""Many random small cases at once: the case number is part of every key.

One Spark job then checks hundreds of cases against the one-by-one models.
"""

from __future__ import annotations

import random

import model
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablesync.operators.classify import OP
from tablesync.operators.constraints import unique_violations, unique_violations_in_order
from tablesync.operators.duplicates import count_writes, dedup
from tablesync.operators.insert_only import accepted_rows
from tablesync.operators.merge import apply_changes, change_set, mirror, upsert

CASES = 400


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(8)


def by_case(rows, width, cases):
    out = {c: [] for c in range(cases)}
    for row in rows:
        out[row[0]].append(tuple(row[1 : 1 + width]))
    return out


@pytest.mark.parametrize("seed, cases", [(1, 60), (100, CASES), (100_000, CASES)])
def test_insert_only_several_keys(spark, scratch, seed, cases):
    rng = random.Random(seed)
    keys = [(0,), (1,), (2, 3)]
    target, source, expected = [], [], {}
    for case in range(cases):

        def row():
            return (
                rng.randrange(10), rng.choice([None, *range(8)]),
                rng.choice([None, 0, 1, 2]), rng.choice([None, 0, 1, 2]),
            )

        old = model.insert_only([], [row() for _ in range(rng.randrange(6))], keys)
        new = [row() for _ in range(rng.randrange(25))]
        expected[case] = sorted(model.insert_only(old, new, keys), key=repr)
        target += [(case, *r) for r in old]
        source += [(case, *r, i) for i, r in enumerate(new)]
    schema = "c int, k int, u int, a int, b int"
    got = accepted_rows(
        frame(spark, source, schema + ", pos int"), frame(spark, target, schema), ("c", "k"),
        scratch, (("c", "u"), ("c", "a", "b")), ("pos",),
    )
    out = by_case(got.collect(), 4, cases)
    assert {c: sorted(r, key=repr) for c, r in out.items()} == expected
    if seed == 100:
        few = accepted_rows(
            frame(spark, source, schema + ", pos int"), frame(spark, target, schema), ("c", "k"),
            scratch, (("c", "u"), ("c", "a", "b")), ("pos",), narrow=True,
        )
        assert rows_of(few) == rows_of(got)


def test_insert_only_long_chain(spark, scratch):
    """Each row clashes with its neighbours only, in source order."""
    n = 100_000
    source = spark.range(n).selectExpr("id AS k", "id div 2 AS u", "(id + 1) div 2 AS w")
    before = len(scratch.paths)
    got = accepted_rows(source, source.limit(0), ("k",), scratch, (("u",), ("w",)), ("k",))
    assert sorted(r.k for r in got.collect()) == list(range(0, n, 2))
    assert len(scratch.paths) - before < 40  # rounds of joins, not one per row


def test_insert_only_key_only(spark, scratch):
    source = frame(spark, [(1, 5, 0), (1, 4, 1), (2, 1, 2), (3, 9, 3)], "k int, v int, pos int")
    target = frame(spark, [(3, 0, 0)], "k int, v int, pos int")
    got = accepted_rows(source, target, ("k",), scratch, order_by=("pos",))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, 0), (2, 1, 2)]


def random_tables(rng, duplicates):
    target, source = {}, {}
    for case in range(CASES):
        values = lambda: (model.small(rng), model.small(rng))
        target[case] = {k: values() for k in rng.sample(range(10), rng.randrange(8))}
        if duplicates:
            picked = [rng.randrange(6) for _ in range(rng.randrange(20))]
        else:
            picked = rng.sample(range(10), rng.randrange(10))
        source[case] = [(k, values()) for k in picked]
    return target, source


def frames(spark, target, source):
    t = [(c, k, *v) for c, rows in target.items() for k, v in rows.items()]
    s = [(c, k, *v, i) for c, rows in source.items() for i, (k, v) in enumerate(rows)]
    columns = "c int, k int, v int, w int"
    return frame(spark, t, columns), frame(spark, s, columns + ", pos int")


@pytest.mark.parametrize("prune", [False, True])
def test_upsert_and_mirror(spark, scratch, prune):
    target, source = random_tables(random.Random(5), duplicates=False)
    t, s = frames(spark, target, source)
    s, key = s.drop("pos"), ("c", "k")
    expected, writes, deleted = [], 0, 0
    for case in range(CASES):
        rows, w, d = model.upsert(target[case], source[case], prune)
        expected += [(case, k, *v) for k, v in rows.items()]
        writes, deleted = writes + w, deleted + d
    expected.sort(key=repr)
    merged = mirror(s, t, key) if prune else upsert(s, t, key)
    assert sorted((tuple(r) for r in merged.collect()), key=repr) == expected
    for part in (None, s):
        changes = scratch.write(change_set(s, t, key, prune, part), "changes")
        counts = {r[OP]: r["count"] for r in changes.groupBy(OP).count().collect()}
        assert counts.get("insert", 0) + counts.get("update", 0) == writes
        assert counts.get("prune", 0) == deleted
        applied = apply_changes(t, changes, key, 16)
        assert sorted((tuple(r) for r in applied.collect()), key=repr) == expected


def test_repeated_keys_last_wins(spark, scratch):
    target, source = random_tables(random.Random(6), duplicates=True)
    t, s = frames(spark, target, source)
    key, writes, expected = ("c", "k"), 0, []
    for case in range(CASES):
        rows, w, _ = model.upsert(target[case], source[case])
        writes += w
        expected += [(case, k, *v) for k, v in rows.items()]
    last = dedup(s, key, ("pos",)).drop("pos")
    merged = sorted((tuple(r) for r in upsert(last, t, key).collect()), key=repr)
    assert merged == sorted(expected, key=repr)
    # A column only the source has must not count; ``pos`` orders rows, no more.
    assert count_writes(s, t, key, ("pos",), scratch).first().writes == writes
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert count_writes(s, t, key, ("pos",), scratch).first().writes == writes
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_write_count_of_one_hot_key(spark, scratch):
    """One key holds nearly all rows: its rows are cut into ranges, not gathered."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(-1).alias("k"),
        (F.col("id") % 3).alias("v"),
        F.col("id").alias("pos"),
    )
    target = spark.createDataFrame([(-1, 1)], "k bigint, v bigint")
    ordered = [(r.k, r.v) for r in rows.orderBy("pos").collect()]
    _, writes, _ = model.upsert({-1: 1}, ordered)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert count_writes(rows, target, ("k",), ("pos",), scratch).first().writes == writes
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    steps = spark.read.parquet(scratch.paths[-1])
    ranges = steps.groupBy(F.shiftright("__pos", 33)).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 5_000


def test_strict_unique_check(spark):
    rng = random.Random(7)
    target, source, expected, final = [], [], [], []
    for case in range(CASES):
        keys = rng.sample(range(10), rng.randrange(8))
        uniques = rng.sample(range(10), len(keys))
        old = {k: rng.choice([None, u]) for k, u in zip(keys, uniques)}
        new = [(k, rng.choice([None, *range(6)])) for k in rng.sample(range(10), rng.randrange(8))]
        expected += [(case, k) for k in model.strict_violations(old, new)]
        after = {**old, **dict(new)}
        held = [u for u in after.values() if u is not None]
        changed = {u for k, u in new if old.get(k, "new") != u}
        final += [
            (case, k)
            for k, u in after.items()
            if u is not None and held.count(u) > 1 and u in changed
        ]
        target += [(case, k, u) for k, u in old.items()]
        source += [(case, k, u, i) for i, (k, u) in enumerate(new)]
    t = frame(spark, target, "c int, k int, u int")
    s = frame(spark, source, "c int, k int, u int, pos int")
    key, unique = ("c", "k"), ("c", "u")
    strict = unique_violations_in_order(s, t, key, unique, ("pos",))
    assert sorted((r.c, r.k) for r in strict.collect()) == sorted(expected)
    changes = change_set(s.drop("pos"), t, key)
    found = unique_violations(t, changes, key, unique)
    assert sorted((r.c, r.k) for r in found.collect()) == sorted(final)


def test_swapped_unique_values(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, u string")
    s = spark.createDataFrame([(1, "b"), (2, "a")], "k int, u string")
    changes = change_set(s, t, ("k",))
    assert unique_violations(t, changes, ("k",), ("u",)).isEmpty()
    strict = unique_violations_in_order(s, t, ("k",), ("u",))
    assert [r.k for r in strict.collect()] == [1]
