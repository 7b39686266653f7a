"""Time the headline jobs and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each job runs twice to warm up and then ``BENCH_RUNS`` times; the median counts.
Plain operators end in a sink that discards rows; ``*_published`` jobs are whole
runs against a stored target, writes and pointer included, with default options: the
check for repeated keys is part of them (``*_trusted_key`` shows a run without it).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablesync import (  # noqa: E402
    BucketedTarget,
    SnapshotTarget,
    SyncOptions,
    TableSpec,
    link_sync,
    sync_table,
)
from tablesync.operators import classify, duplicates, merge, prune, references  # noqa: E402
from tablesync.operators.insert_only import accepted_rows  # noqa: E402
from tablesync.operators.watermark import Watermark  # noqa: E402
from tablesync.queries.inputs import table  # noqa: E402
from tablesync.queries.registry import CUSTOMER, EVENTS, LINE_KEY, ORDERS, QUERIES  # noqa: E402
from tablesync.session import Scratch, scratch_path  # noqa: E402
from tablesync.streaming.runner import read_stream, run_available  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LINES = TableSpec("lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
MULTI = (("l_partkey", "l_shipdate"), ("l_suppkey", "l_extendedprice"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tablesync-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def target(spark: SparkSession, spec: TableSpec, rows: DataFrame | None) -> SnapshotTarget:
    made = SnapshotTarget(spark, scratch_path(spark, f"bench-{spec.name}"), buckets=CPUS)
    if rows is not None:
        link_sync(spark, spec, rows, made)
    return made


def jobs(spark: SparkSession) -> dict[str, tuple[Callable[[], object], Callable[[object], None]]]:
    """name -> (untimed set-up, timed job)."""
    given = {n: table(spark, SF_DIR, n) for n in ("orders", "lineitem", "customer", "events")}
    orders_tgt = table(spark, SF_DIR, "orders_tgt")
    customer_src = table(spark, SF_DIR, "customer_src")
    customer_tgt = table(spark, SF_DIR, "customer_tgt")
    lines = given["lineitem"]
    lines_tgt = lines.withColumn(
        "l_tax", F.when(F.col("l_returnflag") == "A", F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    )
    lines_taken = table(spark, SF_DIR, "lines_taken")
    newest = Watermark("o_orderdate", "timestamp_ntz", "2001-07-10 00:00:00")

    def nothing():
        return None

    def frame(build: Callable[[], DataFrame]):
        return nothing, lambda _: discard(build())

    def since_newest():
        made = target(spark, ORDERS, orders_tgt)
        made.commit(made.pointer().next_with(watermark=newest))
        return made

    def run(spec, source, **options):
        return lambda made: sync_table(spark, spec, source, made, SyncOptions(**options))

    def insert_only(made):
        scratch = Scratch(spark)
        discard(
            accepted_rows(customer_src, customer_tgt, CUSTOMER.key, scratch, CUSTOMER.unique_keys)
        )
        scratch.clear()

    def insert_only_multi(_):
        scratch = Scratch(spark)
        order = [c for c in lines.columns if c not in LINE_KEY]
        discard(accepted_rows(lines, lines_taken, LINE_KEY, scratch, MULTI, order))
        scratch.clear()

    def events_stream(made):
        stream = read_stream(spark, f"{SF_DIR}/events*.parquet", given["events"].schema)
        run_available(EVENTS, stream, made, scratch_path(spark, "bench-stream"))

    def some_deltas():
        made = target(spark, ORDERS, orders_tgt)
        sync_table(spark, ORDERS, given["orders"], made)
        return made

    def bucketed():
        made = BucketedTarget(spark, scratch_path(spark, "bench-bucketed"), buckets=CPUS)
        link_sync(spark, ORDERS, given["orders"], made)
        return made

    def empty_events():
        made = target(spark, EVENTS, None)
        made.create(EVENTS, given["events"].schema)
        return made

    key = ORDERS.key
    return {
        "upsert": frame(lambda: merge.upsert(given["orders"], orders_tgt, key)),
        "mirror": frame(lambda: merge.mirror(given["orders"], orders_tgt, key)),
        "changed_rows": frame(lambda: classify.changed_rows(given["orders"], orders_tgt, key)),
        "prune_keys": frame(lambda: prune.prune_keys(orders_tgt, given["orders"], key)),
        "dedup_last": frame(lambda: duplicates.dedup(given["lineitem"], LINE_KEY, ("l_shipdate",))),
        "orphan_rows": frame(
            lambda: references.orphan_rows(lines, orders_tgt, ("l_orderkey",), ORDERS.key)
        ),
        "upsert_wide": frame(lambda: merge.upsert(lines, lines_tgt, LINES.key)),
        "insert_only": (nothing, insert_only),
        "insert_only_multi": (nothing, insert_only_multi),
        "coerce_row": frame(lambda: QUERIES["coerce_row"](spark, SF_DIR)),
        "first_load_published": (empty_events, run(EVENTS, given["events"])),
        "upsert_published": (
            lambda: target(spark, ORDERS, orders_tgt),
            run(ORDERS, given["orders"]),
        ),
        "upsert_published_trusted_key": (
            lambda: target(spark, ORDERS, orders_tgt),
            run(ORDERS, given["orders"], source_key_is_unique=True),
        ),
        "insert_only_published": (
            lambda: target(spark, CUSTOMER, customer_tgt),
            run(CUSTOMER, customer_src, insert_only=True),
        ),
        "stream_published": (empty_events, events_stream),
        "read_with_deltas": (some_deltas, lambda made: discard(made.load())),
        "compact": (some_deltas, lambda made: made.compact()),
        "mirror_published": (
            lambda: target(spark, ORDERS, orders_tgt),
            run(ORDERS, given["orders"], prune=True, allow_prune=True),
        ),
        "no_change_published": (
            lambda: target(spark, ORDERS, given["orders"]),
            run(ORDERS, given["orders"]),
        ),
        "no_change_bucketed": (bucketed, run(ORDERS, given["orders"])),
        "incremental_published": (
            since_newest,
            run(ORDERS, given["orders"], incremental_col="o_orderdate"),
        ),
        "upsert_wide_published": (
            lambda: target(spark, LINES, lines_tgt),
            run(LINES, lines),
        ),
    }


def main() -> None:
    spark = session()
    times: dict[str, float] = {}
    for name, (set_up, job) in jobs(spark).items():
        taken = []
        for _ in range(RUNS + 2):
            made = set_up()
            start = time.perf_counter()
            job(made)
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[2:]), 4)
        print(f"{name}: {times[name]}", file=sys.stderr)
    line = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
