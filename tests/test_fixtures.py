"""Expected counts of FIXTURES.md at sf0.01, on its modulus-derived views."""

from __future__ import annotations

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tablesync.operators import classify as cl
from tablesync.operators import constraints, duplicates, keys, prune
from tablesync.operators.insert_only import accepted_rows
from tablesync.operators.watermark import Watermark, read_since, watermark_max

VIEWS = {
    "orders_src": "SELECT * FROM orders WHERE o_orderkey % 13 <> 0",
    "orders_tgt": """SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0""",
    "orders_src_nullwm": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders""",
    "customer_src": """SELECT CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1000000
        ELSE c_custkey END AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "customer_tgt": "SELECT * FROM customer WHERE c_custkey % 4 <> 1",
    "conversations_src": "SELECT * FROM conversations WHERE (conv_id + turn) % 5 <> 0",
    "conversations_tgt": "SELECT * FROM conversations WHERE (conv_id + turn) % 3 <> 0",
    "part_src": "SELECT * FROM part",
    "part_tgt": """SELECT p_partkey, p_name, p_brand, p_partkey * 2 AS local_note
        FROM part WHERE p_partkey % 5 <> 0""",
}
KEY = ("o_orderkey",)
SINCE = Watermark("o_orderdate", "timestamp_ntz", "1999-01-01 00:00:00")


@pytest.fixture(scope="module")
def view(spark):
    for name in ("orders", "customer", "conversations", "part", "lineitem"):
        spark.read.parquet(f"{SF01}/{name}.parquet").createOrReplaceTempView(name)
    return lambda name: spark.sql(VIEWS[name]) if name in VIEWS else spark.table(name)


def ops(classified):
    return {r.op: r.n for r in cl.op_counts(classified).collect()}


def test_orders(view):
    s, t = view("orders_src"), view("orders_tgt")
    expected = {"insert": 1384, "keep": 1038, "unchanged": 9711, "update": 2751}
    assert ops(cl.classify(s, t, KEY)) == expected
    part = ops(cl.classify_part(s, t, KEY))
    assert part == {op: n for op, n in expected.items() if op != "keep"}
    plain = s.alias("s").join(t.alias("t"), "o_orderkey").where(
        "s.o_orderstatus <> t.o_orderstatus OR s.o_totalprice <> t.o_totalprice"
    )
    assert plain.count() == 1780  # NULL changes are lost without the null-safe test
    assert prune.prune_keys(t, s, KEY).count() == 1038
    assert keys.high_water_map(s, ["o_orderkey"]) == {"o_orderkey": 14999}


def test_orders_incremental(view):
    s = view("orders_src")
    assert read_since(s, "o_orderdate", SINCE).count() == 5541
    assert s.where(F.col("o_orderdate") > SINCE.literal()).count() == 5533
    assert str(watermark_max(s, "o_orderdate", SINCE).first()[0]) == "2001-08-01 00:00:00"
    gaps = view("orders_src_nullwm")
    assert gaps.where("o_orderdate IS NULL").count() == 883
    assert read_since(gaps, "o_orderdate", SINCE).count() == 5654
    assert read_since(gaps, "o_orderdate", None).count() == 15000


def test_customer(view, scratch):
    s, t, key = view("customer_src"), view("customer_tgt"), ("c_custkey",)
    assert constraints.rekeyed_pairs(s, t, key, ("c_name",)).count() == 30
    assert prune.prune_keys(t, s, key).count() == 30
    assert accepted_rows(s, t, key, scratch, (("c_name",),)).count() == 375
    kept = prune.prune_keep(t, s, key)
    assert constraints.rekeyed_pairs(s, kept, key, ("c_name",)).isEmpty()


def test_conversations(view):
    s, t, key = view("conversations_src"), view("conversations_tgt"), ("conv_id", "turn")
    assert (s.count(), t.count()) == (430, 357)
    assert ops(cl.classify(s, t, key))["insert"] == 146
    assert prune.prune_keys(t, s, key).count() == 73


def test_part_and_lineitem(view):
    s, t = view("part_src"), view("part_tgt")
    assert (s.count(), t.count()) == (2000, 1600)
    assert ops(cl.classify(s, t, ("p_partkey",)))["insert"] == 400
    repeated = duplicates.duplicate_keys(view("lineitem"), ("l_orderkey", "l_linenumber"))
    assert repeated.count() == 11785
