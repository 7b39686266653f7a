"""The registered queries: one per operator, over whole tables, with SQL to compare."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import coerce_to
from tablesync.functions.declared_types import type_name_column
from tablesync.functions.display import display_cells
from tablesync.operators import classify as cl
from tablesync.operators import (
    constraints,
    duplicates,
    inspect,
    keys,
    merge,
    prune,
    references,
    schema,
)
from tablesync.operators.insert_only import accepted_rows
from tablesync.operators.watermark import Watermark, read_since, read_summary, watermark_max
from tablesync.operators.position import with_position
from tablesync.plans.job import (
    STEPS,
    TableJob,
    link_sync,
    retried,
    run_all,
    run_report,
    sync_table,
)
from tablesync.queries.inputs import INPUTS, table, with_inputs
from tablesync.session import Scratch, SharedFiles
from tablesync.sources import catalogue
from tablesync.sources.bucketed import BucketedTarget
from tablesync.sources.readers import footer_session, full_scan
from tablesync.sources.snapshot import SnapshotTarget
from tablesync.sources.state import StateFile
from tablesync.spec import Reference, SyncOptions, TableSpec
from tablesync.streaming.runner import apply_batch, read_stream, run_available, stream_id_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ORDERS = TableSpec("orders", ("o_orderkey",), identity=("o_orderkey",))
CUSTOMER = TableSpec("customer", ("c_custkey",), unique_keys=(("c_name",),))
PART = TableSpec("part", ("p_partkey",), identity=("p_partkey",))
EVENTS = TableSpec("events", ("event_id",))
LINE_KEY = ("l_orderkey", "l_linenumber")
CHAT_KEY = ("conv_id", "turn")
SINCE_1999 = Watermark("o_orderdate", "timestamp_ntz", "1999-01-01 00:00:00")
ORDER_COLUMNS = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
)
QUERY_BUCKETS = 8


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its equal for DuckDB over the derived inputs."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_inputs(sql, *inputs)
        return function

    return register


def _new_target(spark: SparkSession, label: str) -> SnapshotTarget:
    return SnapshotTarget(spark, Scratch(spark).path(label), buckets=QUERY_BUCKETS)


def _filled_target(spark: SparkSession, spec: TableSpec, rows: DataFrame) -> SnapshotTarget:
    target = _new_target(spark, spec.name)
    link_sync(spark, spec, rows, target)
    return target


# -- scans and incremental reads -------------------------------------------------


@query("scan_full", f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_full(spark, sf):
    return full_scan(table(spark, sf, "orders"), ORDER_COLUMNS.split(", "))


@query(
    "incremental_scan",
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'",
)
def incremental_scan(spark, sf):
    rows = read_since(table(spark, sf, "orders"), "o_orderdate", SINCE_1999)
    return rows.select("o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "incremental_null_wm",
    "SELECT o_orderkey, o_orderdate FROM orders_nullwm "
    "WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'",
    ("orders_nullwm",),
)
def incremental_null_wm(spark, sf):
    return read_since(table(spark, sf, "orders_nullwm"), "o_orderdate", SINCE_1999)


@query(
    "watermark_max",
    "SELECT greatest(max(o_orderdate), TIMESTAMP '1999-01-01 00:00:00') AS watermark "
    "FROM orders_nullwm WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'",
    ("orders_nullwm",),
)
def watermark_of_increment(spark, sf):
    rows = read_since(table(spark, sf, "orders_nullwm"), "o_orderdate", SINCE_1999)
    return watermark_max(rows, "o_orderdate", SINCE_1999)


# -- compare, upsert, mirror -------------------------------------------------------

_ORDER_OPS = """
SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep'
            WHEN s.o_custkey IS DISTINCT FROM t.o_custkey
              OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus
              OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
              OR s.o_orderdate IS DISTINCT FROM t.o_orderdate
              OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'update'
            ELSE 'unchanged' END AS op,
       coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey
FROM orders s FULL OUTER JOIN orders_tgt t ON s.o_orderkey = t.o_orderkey
"""


def _orders(spark, sf):
    return table(spark, sf, "orders"), table(spark, sf, "orders_tgt"), ORDERS.key


@query(
    "upsert_classify",
    f"SELECT op, count(*) AS n FROM ({_ORDER_OPS}) GROUP BY op",
    ("orders_tgt",),
)
def upsert_classify(spark, sf):
    return cl.op_counts(cl.classify(*_orders(spark, sf)))


@query(
    "sync_counts",
    f"""SELECT CAST(sum(CASE WHEN op <> 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS read_rows,
               CAST(sum(CASE WHEN op IN ('insert', 'update') THEN 1 ELSE 0 END) AS BIGINT)
                 AS affected_rows,
               CAST(sum(CASE WHEN op = 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS deleted_rows
        FROM ({_ORDER_OPS})""",
    ("orders_tgt",),
)
def sync_counts(spark, sf):
    return cl.sync_counts(cl.classify(*_orders(spark, sf)), prune=True)


@query(
    "changed_rows", f"SELECT o_orderkey FROM ({_ORDER_OPS}) WHERE op = 'update'", ("orders_tgt",)
)
def changed_rows(spark, sf):
    return cl.changed_rows(*_orders(spark, sf))


@query(
    "changed_arrays",
    """SELECT s.vec_id FROM embeddings s JOIN embeddings_tgt t ON s.vec_id = t.vec_id
       WHERE s.embedding IS DISTINCT FROM t.embedding OR s.label IS DISTINCT FROM t.label""",
    ("embeddings_tgt",),
)
def changed_arrays(spark, sf):
    return cl.changed_rows(
        table(spark, sf, "embeddings"), table(spark, sf, "embeddings_tgt"), ("vec_id",)
    )


_UPSERTED = f"""
SELECT {ORDER_COLUMNS} FROM orders
UNION ALL
SELECT {ORDER_COLUMNS} FROM orders_tgt t
WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey)
"""


@query("upsert_result", _UPSERTED, ("orders_tgt",))
def upsert_result(spark, sf):
    return merge.upsert(*_orders(spark, sf))


@query(
    "change_set",
    f"SELECT op, o_orderkey FROM ({_ORDER_OPS}) WHERE op IN ('insert', 'update') "
    f"UNION ALL SELECT 'prune' AS op, o_orderkey FROM ({_ORDER_OPS}) WHERE op = 'keep'",
    ("orders_tgt",),
)
def change_set(spark, sf):
    return merge.change_set(*_orders(spark, sf), prune=True).select(
        F.col(cl.OP).alias("op"), "o_orderkey"
    )


@query(
    "change_set_incremental",
    f"""SELECT op, o_orderkey FROM ({_ORDER_OPS}) WHERE op IN ('insert', 'update')
        AND o_orderkey IN (SELECT o_orderkey FROM orders
                           WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00')
        UNION ALL SELECT 'prune' AS op, o_orderkey FROM ({_ORDER_OPS}) WHERE op = 'keep'""",
    ("orders_tgt",),
)
def change_set_incremental(spark, sf):
    source, target, key = _orders(spark, sf)
    part = read_since(source, "o_orderdate", SINCE_1999)
    changes = merge.change_set(part, target, key, prune=True, all_keys=source)
    return changes.select(F.col(cl.OP).alias("op"), "o_orderkey")


@query(
    "upsert_pk_only",
    "SELECT conv_id, turn FROM conversations UNION SELECT conv_id, turn FROM conversations_src",
    ("conversations_src",),
)
def upsert_pk_only(spark, sf):
    return merge.upsert_keys(
        table(spark, sf, "conversations_src"), table(spark, sf, "conversations"), CHAT_KEY
    )


@query(
    "mirror_sync",
    """SELECT s.*, t.o_orderpriority || '/' || t.o_orderstatus AS note
       FROM orders s LEFT JOIN orders_tgt t ON s.o_orderkey = t.o_orderkey""",
    ("orders_tgt",),
)
def mirror_sync(spark, sf):
    """Like the source, but for a column that only the target has."""
    source, target, key = _orders(spark, sf)
    note = F.concat("o_orderpriority", F.lit("/"), "o_orderstatus")
    return merge.mirror(source, target.withColumn("note", note), key)


@query(
    "rekey_mirror",
    """SELECT s.*, t.c_name AS old_name
       FROM customer_src s LEFT JOIN customer_tgt t ON s.c_custkey = t.c_custkey""",
    ("customer_src", "customer_tgt"),
)
def rekey_mirror(spark, sf):
    """A whole run with its unique check: rows whose key changed take over their names."""
    old = table(spark, sf, "customer_tgt").withColumn("old_name", F.col("c_name"))
    target = _filled_target(spark, CUSTOMER, old)
    options = SyncOptions(prune=True, allow_prune=True)
    sync_table(spark, CUSTOMER, table(spark, sf, "customer_src"), target, options)
    return target.load()


# -- prune ---------------------------------------------------------------------------


@query(
    "prune_keys",
    "SELECT o_orderkey FROM orders_tgt t "
    "WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey)",
    ("orders_tgt",),
)
def prune_keys(spark, sf):
    source, target, key = _orders(spark, sf)
    return prune.prune_keys(target, source, key)


@query(
    "prune_keep",
    f"SELECT {ORDER_COLUMNS} FROM orders_tgt t "
    "WHERE EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey)",
    ("orders_tgt",),
)
def prune_keep(spark, sf):
    source, target, key = _orders(spark, sf)
    return prune.prune_keep(target, source, key)


@query(
    "prune_composite",
    "SELECT conv_id, turn FROM conversations t WHERE NOT EXISTS (SELECT 1 "
    "FROM conversations_src s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)",
    ("conversations_src",),
)
def prune_composite(spark, sf):
    return prune.prune_keys(
        table(spark, sf, "conversations"), table(spark, sf, "conversations_src"), CHAT_KEY
    )


# -- insert-only -----------------------------------------------------------------------

_ACCEPTED = """
SELECT s.* FROM customer_src s
WHERE NOT EXISTS (SELECT 1 FROM customer_tgt t WHERE t.c_custkey = s.c_custkey)
  AND NOT EXISTS (SELECT 1 FROM customer_tgt t WHERE t.c_name = s.c_name)
"""


@query(
    "insert_only",
    f"SELECT * FROM customer_tgt UNION ALL {_ACCEPTED}",
    ("customer_src", "customer_tgt"),
)
def insert_only(spark, sf):
    source, target = table(spark, sf, "customer_src"), table(spark, sf, "customer_tgt")
    new = accepted_rows(source, target, CUSTOMER.key, Scratch(spark), CUSTOMER.unique_keys)
    return target.unionByName(new)


_LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"


@query(
    "insert_only_first",
    f"""SELECT {_LINE_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {_LINE_ORDER}) AS n
          FROM lineitem s WHERE NOT EXISTS (SELECT 1 FROM lines_taken t
            WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber))
        WHERE n = 1""",
    ("lines_taken",),
)
def insert_only_first(spark, sf):
    new = accepted_rows(
        table(spark, sf, "lineitem"), table(spark, sf, "lines_taken"), LINE_KEY,
        Scratch(spark), order_by=_LINE_ORDER.split(", "),
    )
    return new.select(*_LINE_COLUMNS.split(", "))


_MULTI_KEYS = (LINE_KEY, ("l_partkey", "l_shipdate"), ("l_suppkey", "l_extendedprice"))


def _free_of(columns: tuple[str, ...]) -> str:
    same = " AND ".join(f"t.{c} = s.{c}" for c in columns)
    return f"NOT EXISTS (SELECT 1 FROM lines_taken t WHERE {same})"


def _first_of(columns: tuple[str, ...]) -> str:
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"CASE WHEN {missing} THEN pos ELSE min(pos) OVER (PARTITION BY {', '.join(columns)}) END"


# Each step lets the rows win that come first for all their values and carries on the rows
# that share no value with a winner.
_MULTI = f"""
SELECT * FROM (
  WITH RECURSIVE src AS (
    SELECT *, row_number() OVER (ORDER BY {_LINE_ORDER}, l_orderkey, l_linenumber) AS pos
    FROM lineitem s WHERE {" AND ".join(map(_free_of, _MULTI_KEYS))}),
  k AS (SELECT pos, {", ".join(f"{_first_of(c)} AS {n}" for c, n in zip(_MULTI_KEYS, "abc"))} FROM src),
  r AS (
    SELECT pos, a, b, c, false AS won FROM k
    UNION ALL
    SELECT pos, a, b, c, w FROM (
      SELECT *, bool_or(w) OVER (PARTITION BY a) AS ha, bool_or(w) OVER (PARTITION BY b) AS hb,
             bool_or(w) OVER (PARTITION BY c) AS hc
      FROM (SELECT pos, a, b, c, pos = min(pos) OVER (PARTITION BY a)
                AND pos = min(pos) OVER (PARTITION BY b)
                AND pos = min(pos) OVER (PARTITION BY c) AS w FROM r WHERE NOT won))
    WHERE w OR NOT (ha OR hb OR hc))
  SELECT {_LINE_COLUMNS} FROM src WHERE pos IN (SELECT pos FROM r WHERE won))
"""


@query("insert_only_multi", _MULTI, ("lines_taken",))
def insert_only_multi(spark, sf):
    """Three contested keys; each row waits for all earlier ones."""
    new = accepted_rows(
        table(spark, sf, "lineitem"), table(spark, sf, "lines_taken"), LINE_KEY,
        Scratch(spark), _MULTI_KEYS[1:], _LINE_ORDER.split(", "),
    )
    return new.select(*_LINE_COLUMNS.split(", "))


# -- constraints and duplicates ----------------------------------------------------------


@query(
    "rekey_conflicts",
    """SELECT s.c_name, s.c_custkey AS source_c_custkey, t.c_custkey AS target_c_custkey
       FROM customer_src s JOIN customer_tgt t ON s.c_name = t.c_name
       WHERE s.c_custkey <> t.c_custkey""",
    ("customer_src", "customer_tgt"),
)
def rekey_conflicts(spark, sf):
    return constraints.rekeyed_pairs(
        table(spark, sf, "customer_src"), table(spark, sf, "customer_tgt"),
        CUSTOMER.key, ("c_name",),
    )


@query(
    "unique_violations",
    """SELECT * FROM (
       WITH src AS (SELECT *, row_number() OVER () - 1 AS pos FROM customer_src),
            bad AS (SELECT c_custkey, c_name FROM (
              SELECT c_custkey, c_name, count(*) OVER (PARTITION BY c_name) AS n FROM (
                SELECT c_custkey, c_name FROM customer_src UNION ALL
                SELECT c_custkey, c_name FROM customer_tgt t WHERE NOT EXISTS (
                  SELECT 1 FROM customer_src s WHERE s.c_custkey = t.c_custkey)))
              WHERE n > 1)
       SELECT c_custkey, c_name, (SELECT min(pos) FROM src WHERE src.c_name = bad.c_name) AS first_row,
              (SELECT max(pos) FROM src WHERE src.c_name = bad.c_name) AS last_row
       FROM bad)""",
    ("customer_src", "customer_tgt"),
)
def unique_violations(spark, sf):
    """Rows that would share a name, and where the source rows that have it begin and end."""
    target = table(spark, sf, "customer_tgt")
    given = with_position(table(spark, sf, "customer"))
    moved = F.when(F.col("c_mktsegment") == "BUILDING", -1 - F.col("c_custkey"))
    source = given.withColumn("c_custkey", F.coalesce(moved, "c_custkey"))
    changes = merge.change_set(source, target, CUSTOMER.key)
    found = constraints.unique_violations(target, changes, CUSTOMER.key, ("c_name",))
    ranges = constraints.row_ranges(source, found, ("c_name",))
    return found.join(ranges, "c_name").select(
        "c_custkey", "c_name",
        F.col("first_row.row").alias("first_row"), F.col("last_row.row").alias("last_row"),
    )


@query(
    "unique_violations_in_order",
    """SELECT c_custkey, c_name FROM (
         SELECT c_custkey, c_name,
                row_number() OVER (PARTITION BY c_name ORDER BY c_custkey) AS n
         FROM customer_src) WHERE n > 1
       UNION
       SELECT s.c_custkey, s.c_name FROM customer_src s
       JOIN customer_tgt t ON t.c_name = s.c_name AND t.c_custkey <> s.c_custkey
       LEFT JOIN customer_src m ON m.c_custkey = t.c_custkey
       WHERE m.c_custkey IS NULL OR m.c_custkey > s.c_custkey""",
    ("customer_src", "customer_tgt"),
)
def unique_violations_in_order(spark, sf):
    found = constraints.unique_violations_in_order(
        table(spark, sf, "customer_src"), table(spark, sf, "customer_tgt"),
        CUSTOMER.key, ("c_name",),
    )
    return found.select("c_custkey", "c_name")


@query(
    "null_key_check",
    "SELECT p_name, p_brand, p_type, p_retailprice FROM part_nokey WHERE p_partkey IS NULL",
    ("part_nokey",),
)
def null_key_check(spark, sf):
    found = constraints.null_key_rows(table(spark, sf, "part_nokey"), PART.key)
    return found.select("p_name", "p_brand", "p_type", "p_retailprice")


@query(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def dup_keys(spark, sf):
    return duplicates.duplicate_keys(table(spark, sf, "lineitem"), LINE_KEY)


@query(
    "dedup_last",
    f"""SELECT {_LINE_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER.split(', '))}) AS n
          FROM lineitem) WHERE n = 1""",
)
def dedup_last(spark, sf):
    rows = duplicates.dedup(table(spark, sf, "lineitem"), LINE_KEY, _LINE_ORDER.split(", "))
    return rows.select(*_LINE_COLUMNS.split(", "))


@query(
    "dedup_last_in_scan_order",
    f"""SELECT {_LINE_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY pos DESC) AS n
          FROM (SELECT *, row_number() OVER () AS pos FROM lineitem)) WHERE n = 1""",
)
def dedup_last_in_scan_order(spark, sf):
    """No order is declared: of the rows of a key the one read last stays."""
    rows = duplicates.dedup(table(spark, sf, "lineitem"), LINE_KEY)
    return rows.select(*_LINE_COLUMNS.split(", "))


@query(
    "applied_writes",
    """SELECT CAST(sum(CASE
         WHEN n = 1 AND t.l_orderkey IS NULL THEN 1
         WHEN n = 1 AND (s.l_partkey IS DISTINCT FROM t.l_partkey
                      OR s.l_suppkey IS DISTINCT FROM t.l_suppkey
                      OR s.l_quantity IS DISTINCT FROM t.l_quantity) THEN 1
         WHEN n > 1 AND (s.l_partkey IS DISTINCT FROM p_part
                      OR s.l_suppkey IS DISTINCT FROM p_supp
                      OR s.l_quantity IS DISTINCT FROM p_qty) THEN 1
         ELSE 0 END) AS BIGINT) AS writes
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                    row_number() OVER w AS n, lag(l_partkey) OVER w AS p_part,
                    lag(l_suppkey) OVER w AS p_supp, lag(l_quantity) OVER w AS p_qty
             FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber
                                        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity)) s
       LEFT JOIN lineitem_tgt t
         ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber""",
    ("lineitem_tgt",),
)
def applied_writes(spark, sf):
    source = table(spark, sf, "lineitem").select(*_LINE_COLUMNS.split(", "))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return duplicates.count_writes(
        source, table(spark, sf, "lineitem_tgt"), LINE_KEY, order, Scratch(spark)
    )


@query(
    "orphan_rows",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM orders_tgt o WHERE o.o_orderkey = l.l_orderkey)""",
    ("orders_tgt",),
)
def orphan_rows(spark, sf):
    """Line items whose order is gone."""
    found = references.orphan_rows(
        table(spark, sf, "lineitem"), table(spark, sf, "orders_tgt"), ("l_orderkey",), ORDERS.key
    )
    return found.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "missing_parents",
    """SELECT c_custkey AS o_custkey, count(*) AS n_rows FROM (
         SELECT o_custkey AS c_custkey FROM orders) o
       WHERE NOT EXISTS (SELECT 1 FROM customer_src c WHERE c.c_custkey = o.c_custkey)
       GROUP BY c_custkey""",
    ("customer_src",),
)
def missing_parents(spark, sf):
    """Customers that orders name and the table lacks, with their orders."""
    return references.missing_parents(
        table(spark, sf, "orders"), table(spark, sf, "customer_src"), ("o_custkey",), CUSTOMER.key
    )


# -- values ----------------------------------------------------------------------------------

_WORDS = "('1', 't', 'true', 'y', 'yes', 'on')"


@query(
    "coerce_bool",
    f"""SELECT doc_id, flag_int <> 0 AS flag_int, flag_real <> 0 AS flag_real,
               lower(regexp_replace(flag_text, '^\\s+|\\s+$', '', 'g')) IN {_WORDS} AS flag_text
        FROM documents_flags""",
    ("documents_flags",),
)
def coerce_bool(spark, sf):
    flag = T.BooleanType()
    wanted = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("flag_int", flag),
            T.StructField("flag_real", flag),
            T.StructField("flag_text", flag),
        ]
    )
    return coerce_to(table(spark, sf, "documents_flags"), wanted)


@query(
    "coerce_binary",
    "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, md5(text) AS digest FROM documents",
)
def coerce_binary(spark, sf):
    wanted = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.BinaryType())]
    )
    rows = coerce_to(table(spark, sf, "documents"), wanted)
    return rows.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.md5("text").alias("digest"),
    )


@query(
    "coerce_row",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
              CAST(round_even(o_custkey, 0) AS BIGINT) AS o_custkey, o_orderstatus,
              CAST(o_totalprice AS DOUBLE) AS o_totalprice,
              CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority
       FROM orders_text""",
    ("orders_text",),
)
def coerce_row(spark, sf):
    return coerce_to(table(spark, sf, "orders_text"), table(spark, sf, "orders").schema)


@query(
    "type_map",
    r"""SELECT p_partkey, CASE
          WHEN d LIKE '%BOOL%' THEN 'boolean'
          WHEN d LIKE '%DATETIME%' OR d LIKE '%TIMESTAMP%' THEN 'timestamp'
          WHEN d LIKE '%DATE%' THEN 'date'
          WHEN (d LIKE '%DECIMAL%' OR d LIKE '%NUMERIC%')
               AND regexp_matches(d, '\(\s*\d+\s*,\s*\d+\s*\)')
            THEN 'numeric(' || regexp_extract(d, '\(\s*(\d+)\s*,\s*(\d+)\s*\)', 1) || ','
                 || regexp_extract(d, '\(\s*(\d+)\s*,\s*(\d+)\s*\)', 2) || ')'
          WHEN d LIKE '%DECIMAL%' OR d LIKE '%NUMERIC%' THEN 'numeric'
          WHEN d LIKE '%CHAR%' OR d LIKE '%CLOB%' OR d LIKE '%TEXT%' THEN 'text'
          WHEN d LIKE '%INT%' THEN 'bigint'
          WHEN d LIKE '%REAL%' OR d LIKE '%FLOA%' OR d LIKE '%DOUB%' THEN 'double precision'
          WHEN d LIKE '%BLOB%' THEN 'bytea'
          WHEN d = '' THEN 'text' ELSE 'numeric' END AS target_type
        FROM (SELECT p_partkey, upper(coalesce(declared, '')) AS d FROM part_declared)""",
    ("part_declared",),
)
def type_map(spark, sf):
    return table(spark, sf, "part_declared").select(
        "p_partkey", type_name_column(F.col("declared")).alias("target_type")
    )


@query(
    "display_cells",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
              CASE WHEN length(text) <= 40 THEN text ELSE substr(text, 1, 39) || '…' END AS text,
              '<BLOB ' || strlen(text) || 'B>' AS body,
              coalesce(nullif(lang, 'en'), 'NULL') AS lang
       FROM documents""",
)
def display(spark, sf):
    return display_cells(
        table(spark, sf, "documents").select(
            "doc_id",
            "text",
            F.encode("text", "UTF-8").alias("body"),
            F.nullif(F.col("lang"), F.lit("en")).alias("lang"),
        )
    )


# -- schema ------------------------------------------------------------------------------------


def _part_diff(spark, sf):
    source, target = table(spark, sf, "part"), table(spark, sf, "part_tgt")
    return source, target, schema.schema_diff(source.schema, target.schema)


@query(
    "schema_diff",
    """SELECT 'p_type' AS "column", 'add' AS action, 'string' AS type, count(p_type) AS n_values
       FROM part
       UNION ALL SELECT 'p_retailprice', 'add', 'double', count(p_retailprice) FROM part
       UNION ALL SELECT 'local_note', 'target_only', 'string', count(local_note) FROM part_tgt
       UNION ALL SELECT 'p_size', 'retype', 'string -> int', count(p_size) FROM part_tgt""",
    ("part_tgt",),
)
def schema_differences(spark, sf):
    return schema.schema_diff_counts(*_part_diff(spark, sf))


@query(
    "schema_plan",
    """SELECT 'p_type' AS "column", 'string' AS type, count(p_type) AS filled_rows FROM part
       UNION ALL SELECT 'p_retailprice', 'double', count(p_retailprice) FROM part""",
)
def schema_plan(spark, sf):
    """Columns a dry run would add, and how many source rows would fill them."""
    rows = schema.schema_diff_counts(*_part_diff(spark, sf)).where(F.col("action") == schema.ADD)
    return rows.select("column", "type", F.col("n_values").alias("filled_rows"))


@query(
    "add_columns",
    """SELECT p_partkey, p_name, p_brand, p_size, local_note, CAST(NULL AS VARCHAR) AS p_type,
              CAST(NULL AS DOUBLE) AS p_retailprice FROM part_tgt""",
    ("part_tgt",),
)
def add_columns(spark, sf):
    _, target, diff = _part_diff(spark, sf)
    return schema.add_columns(target, diff)


_BACKFILLED = """
SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey,
       CASE WHEN s.p_partkey IS NULL THEN t.p_name ELSE s.p_name END AS p_name,
       CASE WHEN s.p_partkey IS NULL THEN t.p_brand ELSE s.p_brand END AS p_brand,
       t.local_note, s.p_type, s.p_retailprice
FROM part s FULL OUTER JOIN part_link t ON s.p_partkey = t.p_partkey
"""


@query("add_columns_backfill", _BACKFILLED, ("part_link",))
def add_columns_backfill(spark, sf):
    """A full run after new columns were added fills old rows."""
    source = table(spark, sf, "part").drop("p_size")
    target = _filled_target(spark, PART, table(spark, sf, "part_link"))
    sync_table(spark, PART, source, target, SyncOptions(add_columns=True))
    return target.load()


@query("column_intersection", "SELECT p_partkey, p_name, p_brand FROM part")
def column_intersection(spark, sf):
    return schema.column_intersection(
        table(spark, sf, "part"), table(spark, sf, "part_link")
    )


# -- whole runs against a stored target --------------------------------------------------------


@query("create_and_load", "SELECT * FROM customer")
def create_and_load(spark, sf):
    return _filled_target(spark, CUSTOMER, table(spark, sf, "customer")).load()


_LINKED = """
SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey,
       CASE WHEN s.p_partkey IS NULL THEN t.p_name ELSE s.p_name END AS p_name,
       CASE WHEN s.p_partkey IS NULL THEN t.p_brand ELSE s.p_brand END AS p_brand,
       t.local_note
FROM part s FULL OUTER JOIN part_link t ON s.p_partkey = t.p_partkey
"""


@query("link_sync", _LINKED, ("part_link",))
def linked(spark, sf):
    """Only shared columns are synced; a column of the target alone keeps its values."""
    target = _filled_target(spark, PART, table(spark, sf, "part_link"))
    link_sync(spark, PART, table(spark, sf, "part"), target)
    return target.load()


@query(
    "link_sync_report",
    """SELECT false AS created,
              (SELECT count(*) FROM part s LEFT JOIN part_link t ON s.p_partkey = t.p_partkey
               WHERE t.p_partkey IS NULL OR s.p_name IS DISTINCT FROM t.p_name
                  OR s.p_brand IS DISTINCT FROM t.p_brand) AS affected_rows,
              (SELECT count(*) FROM part_link t WHERE NOT EXISTS
                (SELECT 1 FROM part s WHERE s.p_partkey = t.p_partkey)) AS pruned_rows,
              (SELECT coalesce(max(p_partkey), 1) FROM part) AS p_partkey""",
    ("part_link",),
)
def link_report(spark, sf):
    target = _filled_target(spark, PART, table(spark, sf, "part_link"))
    report = link_sync(spark, PART, table(spark, sf, "part"), target, prune=True)
    return report.select(
        "created", "affected_rows", "pruned_rows", F.col("sequences")["p_partkey"].alias("p_partkey")
    )


@query(
    "link_sync_own_key",
    """SELECT s.conv_id, s.turn, s.role, s.text FROM conversations s""",
)
def link_sync_own_key(spark, sf):
    """A key given for an existing target is ignored: the target's own key counts."""
    chat = table(spark, sf, "conversations")
    spec = TableSpec("chat", CHAT_KEY)
    target = _filled_target(spark, spec, chat.withColumn("text", F.upper("text")))
    link_sync(spark, TableSpec("chat", ("role",)), chat, target)
    return target.load().select("conv_id", "turn", "role", "text")


@query("publish_upsert", _UPSERTED, ("orders_tgt",))
def publish_upsert(spark, sf):
    """Two runs: the second finds nothing to change and publishes nothing."""
    target = _filled_target(spark, ORDERS, table(spark, sf, "orders_tgt"))
    for _ in range(2):
        sync_table(spark, ORDERS, table(spark, sf, "orders"), target)
    return target.load()


@query("publish_bucketed", _UPSERTED, ("orders_tgt",))
def publish_bucketed(spark, sf):
    """A target of bucketed tables: the stored side of a whole run is read in place."""
    target = BucketedTarget(spark, Scratch(spark).path("orders"), buckets=QUERY_BUCKETS)
    link_sync(spark, ORDERS, table(spark, sf, "orders_tgt"), target)
    sync_table(spark, ORDERS, table(spark, sf, "orders"), target)
    return target.load()


@query(
    "retry_after_failure",
    f"""SELECT *, (SELECT CAST(max(o_orderdate) AS VARCHAR) FROM orders) AS watermark
        FROM ({_UPSERTED})""",
    ("orders_tgt",),
)
def retry_after_failure(spark, sf):
    """Runs that break at each step of publishing, each started again, end like a clean one."""
    target = _filled_target(spark, ORDERS, table(spark, sf, "orders_tgt"))
    options = SyncOptions(incremental_col="o_orderdate", sync_sequence=True)
    for broken in STEPS:
        failures = [OSError(f"lost after: {broken}")]

        def fail_once(step, broken=broken, failures=failures):
            if step == broken and failures:
                raise failures.pop()

        def run(fail_once=fail_once):
            given = table(spark, sf, "orders")
            return sync_table(spark, ORDERS, given, target, options, on_step=fail_once)

        retried(run, attempts=2)
    stored = target.pointer().watermark.value
    return target.load().withColumn("watermark", F.lit(stored))


@query(
    "run_parents_first",
    """SELECT 'lineitem' AS "table", true AS failed, 0 AS n_rows
       UNION ALL SELECT 'orders', false, count(*) FROM orders
       UNION ALL SELECT 'customer', false, count(*) FROM customer""",
)
def run_parents_first(spark, sf):
    """Given children first: parents are synced before, and a child without parents fails."""
    lines = table(spark, sf, "lineitem").dropDuplicates(list(LINE_KEY))
    lost = lines.withColumn("l_orderkey", -F.col("l_orderkey") - 1)
    to_orders = Reference("l_orderkey", "orders", "o_orderkey")
    to_customer = Reference("o_custkey", "customer", "c_custkey")
    specs = {
        "lineitem": TableSpec("lineitem", LINE_KEY, references=[to_orders]),
        "orders": TableSpec("orders", ORDERS.key, references=[to_customer]),
        "customer": TableSpec("customer", CUSTOMER.key),
    }
    rows = {"lineitem": lost, "orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}
    jobs = []
    for name, spec in specs.items():
        target = _new_target(spark, name)
        target.create(spec, rows[name].schema)
        jobs.append(TableJob(spec, lambda name=name: rows[name], target))
    result = run_all(spark, jobs)
    found = [(r.table, r.error is not None, j.target.load().count()) for r, j in zip(result.reports, jobs)]
    return spark.createDataFrame(found, "table string, failed boolean, n_rows long")


@query(
    "publish_incremental",
    f"""SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'
        UNION ALL
        SELECT {ORDER_COLUMNS} FROM orders_tgt t WHERE
          EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey
                  AND s.o_orderdate < TIMESTAMP '1999-01-01 00:00:00')""",
    ("orders_tgt",),
)
def publish_incremental(spark, sf):
    """Prune looks at every source key, the upsert only at rows since the watermark."""
    target = _filled_target(spark, ORDERS, table(spark, sf, "orders_tgt"))
    target.commit(target.pointer().next_with(watermark=SINCE_1999))
    options = SyncOptions(incremental_col="o_orderdate", prune=True, allow_prune=True)
    sync_table(spark, ORDERS, table(spark, sf, "orders"), target, options)
    return target.load()


@query(
    "publish_insert_only",
    f"SELECT * FROM customer_tgt UNION ALL {_ACCEPTED}",
    ("customer_src", "customer_tgt"),
)
def publish_insert_only(spark, sf):
    target = _filled_target(spark, CUSTOMER, table(spark, sf, "customer_tgt"))
    options = SyncOptions(insert_only=True)
    sync_table(spark, CUSTOMER, table(spark, sf, "customer_src"), target, options)
    return target.load()


@query(
    "run_report",
    f"""SELECT 'orders' AS "table", 'full' AS mode,
               CAST(sum(CASE WHEN op <> 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS read_rows,
               CAST(sum(CASE WHEN op IN ('insert', 'update') THEN 1 ELSE 0 END) AS BIGINT)
                 AS affected_rows,
               CAST(sum(CASE WHEN op = 'keep' THEN 1 ELSE 0 END) AS BIGINT) AS deleted_rows,
               false AS failed
        FROM ({_ORDER_OPS})
        UNION ALL SELECT 'customer', 'full', 0, 0, 0, true
        UNION ALL SELECT 'events', 'incremental', count(*), count(*), 0, false FROM events""",
    ("orders_tgt",),
)
def report_of_run(spark, sf):
    """Three tables; the second breaks a unique key and does not stop the third."""
    orders = _filled_target(spark, ORDERS, table(spark, sf, "orders_tgt"))
    customer = _filled_target(spark, CUSTOMER, table(spark, sf, "customer_tgt"))
    events = _new_target(spark, "events")
    events.create(EVENTS, table(spark, sf, "events").schema)
    mirror = SyncOptions(prune=True, allow_prune=True, sync_sequence=True)
    since = SyncOptions(incremental_col="ts")
    result = run_all(
        spark,
        [
            TableJob(ORDERS, lambda: table(spark, sf, "orders"), orders, mirror),
            TableJob(CUSTOMER, lambda: table(spark, sf, "customer_src"), customer),
            TableJob(EVENTS, lambda: table(spark, sf, "events"), events, since),
        ],
    )
    rows = run_report(spark, result)
    return rows.select(
        "table", "mode", "read_rows", "affected_rows", "deleted_rows",
        F.col("error").isNotNull().alias("failed"),
    )


@query(
    "stream_sync",
    """SELECT * FROM events UNION ALL
       SELECT * FROM events_tgt t WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.event_id = t.event_id)""",
    ("events_tgt",),
)
def stream_sync(spark, sf):
    """Several files, a batch each, merged into a filled target; a second start adds nothing."""
    target = _filled_target(spark, EVENTS, table(spark, sf, "events_tgt"))
    given = table(spark, sf, "events")
    files, checkpoint = Scratch(spark).path("events"), Scratch(spark).path("stream")
    given.repartition(4, "event_id").write.parquet(files)
    stream = read_stream(spark, files, given.schema, files_per_batch=1)
    for _ in range(2):
        run_available(EVENTS, stream, target, checkpoint, SyncOptions(incremental_col="ts"))
    return target.load()


@query("stream_two_checkpoints", _UPSERTED, ("orders_tgt",))
def stream_two_checkpoints(spark, sf):
    """One target fed by two streams with batch numbers of their own, one batch twice."""
    target = _new_target(spark, "orders")
    given = table(spark, sf, "orders")
    target.create(ORDERS, given.schema)
    checks = [Scratch(spark).path("stream") for _ in range(2)]
    old = read_stream(spark, f"{sf}/orders*.parquet", given.schema)
    old.createOrReplaceTempView("orders")
    run_available(ORDERS, spark.sql(INPUTS["orders_tgt"][1]), target, checks[0])
    run_available(ORDERS, read_stream(spark, f"{sf}/orders*.parquet", given.schema), target, checks[1])
    again = table(spark, sf, "orders_tgt")
    apply_batch(ORDERS, target, again, stream_id_of(spark, checks[0]), 0)
    return target.load()


@query("publish_compact", _UPSERTED, ("orders_tgt",))
def publish_compact(spark, sf):
    """Changes kept as deltas, then folded into a new base."""
    target = _filled_target(spark, ORDERS, table(spark, sf, "orders_tgt"))
    sync_table(spark, ORDERS, table(spark, sf, "orders"), target)
    target.compact()
    return target.load()


@query(
    "link_sync_repeats",
    "SELECT conv_id, turn FROM conversations UNION SELECT conv_id, turn FROM conversations_src",
    ("conversations_src",),
)
def link_sync_repeats(spark, sf):
    """A table that is all key ignores repeated rows of its source."""
    spec = TableSpec("chat", CHAT_KEY)
    target = _filled_target(spark, spec, table(spark, sf, "conversations").select(*CHAT_KEY))
    more = table(spark, sf, "conversations_src").select(*CHAT_KEY)
    link_sync(spark, spec, more.unionByName(more), target)
    return target.load()


@query(
    "upsert_without_unique_column",
    """SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, t.c_name,
              CASE WHEN s.c_custkey IS NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey,
              CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
              CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
       FROM customer_src s FULL OUTER JOIN customer_tgt t ON s.c_custkey = t.c_custkey""",
    ("customer_src", "customer_tgt"),
)
def upsert_without_unique_column(spark, sf):
    """The source lacks a unique column of the target: kept in old rows, NULL in new ones."""
    target = _filled_target(spark, CUSTOMER, table(spark, sf, "customer_tgt"))
    sync_table(spark, CUSTOMER, table(spark, sf, "customer_src").drop("c_name"), target)
    return target.load()


_BEFORE_1999 = "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"


@query(
    "watermark_rules",
    f"""WITH t AS (SELECT count(*) AS n, max(o_orderdate) AS top, max(o_custkey) AS cust FROM orders),
             low AS (SELECT count(*) AS n, max(o_orderdate) AS top FROM orders WHERE {_BEFORE_1999})
        SELECT '1 first run reads all' AS step, n AS read_rows, n AS affected_rows,
               CAST(top AS VARCHAR) AS watermark FROM t
        UNION ALL SELECT '2 from the bound on', (SELECT count(*) FROM orders, t WHERE o_orderdate = top),
                         0, CAST(top AS VARCHAR) FROM t
        UNION ALL SELECT '3 a full run leaves it', n, 0, CAST(top AS VARCHAR) FROM t
        UNION ALL SELECT '4 late rows are not seen', 0, 0, CAST(top AS VARCHAR) FROM t
        UNION ALL SELECT '5 a refresh may lower it', low.n, 0, CAST(low.top AS VARCHAR) FROM low
        UNION ALL SELECT '6 nothing to save keeps it', 0, 0, CAST(low.top AS VARCHAR) FROM low
        UNION ALL SELECT '7 another column is a first run', n, 0, CAST(cust AS VARCHAR) FROM t""",
)
def watermark_rules(spark, sf):
    """Runs one after another over one target; rows read, rows written, watermark stored."""
    given = table(spark, sf, "orders")
    target = _new_target(spark, "orders")
    target.create(ORDERS, given.schema)
    by_date, refresh = {"incremental_col": "o_orderdate"}, {"full_refresh": True}
    early = given.where(_BEFORE_1999)
    steps = (
        ("1 first run reads all", given, by_date),
        ("2 from the bound on", given, by_date),
        ("3 a full run leaves it", given, {}),
        ("4 late rows are not seen", early.withColumn("o_totalprice", -F.col("o_totalprice")), by_date),
        ("5 a refresh may lower it", early, by_date | refresh),
        ("6 nothing to save keeps it", given.where("false"), by_date | refresh),
        ("7 another column is a first run", given, {"incremental_col": "o_custkey"}),
    )
    rows = []
    for step, source, options in steps:
        report = sync_table(spark, ORDERS, source, target, SyncOptions(**options))
        stored = target.pointer().watermark.value
        rows.append((step, report.read_rows, report.affected_rows, stored))
    return spark.createDataFrame(
        rows, "step string, read_rows long, affected_rows long, watermark string"
    )


@query(
    "dry_run",
    """SELECT unnest(['p_type', 'p_size', 'p_retailprice']) AS missing,
              (SELECT count(*) FROM part_link) AS rows_after""",
    ("part_link",),
)
def dry_run(spark, sf):
    """A dry run tells the missing columns and leaves the target as it is."""
    target = _filled_target(spark, PART, table(spark, sf, "part_link"))
    options = SyncOptions(dry_run=True, add_columns=True)
    report = sync_table(spark, PART, table(spark, sf, "part"), target, options)
    names = spark.createDataFrame([(name,) for name in report.added_columns], "missing string")
    after = target.load().agg(F.count("*").alias("rows_after"))
    return names.join(after, F.lit(True))


# -- looking at tables -----------------------------------------------------------------------


@query(
    "key_high_water",
    """SELECT 'o_orderkey' AS "column", coalesce(max(o_orderkey), 1) AS high_water FROM orders
       UNION ALL SELECT 'o_custkey', coalesce(max(o_custkey), 1) FROM orders""",
)
def key_high_water(spark, sf):
    """Answered from file footers."""
    orders = table(footer_session(spark), sf, "orders")
    return keys.key_high_water(orders, ["o_orderkey", "o_custkey"])


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS n_rows FROM {name}" for name in _TABLES
    ),
)
def table_counts(spark, sf):
    """Answered from file footers."""
    own = footer_session(spark)
    return inspect.table_counts({name: table(own, sf, name) for name in _TABLES})


_KEYS = {
    "orders": ("o_orderkey",),
    "conversations": ("conv_id", "turn"),
    "part_nokey": ("p_partkey",),
    "lineitem": ("l_linenumber", "l_orderkey"),
}


@query(
    "key_columns",
    """SELECT 'orders' AS "table", 'o_orderkey' AS "column", 1 AS ordinal, 1 AS key_ordinal,
              'bigint' AS type, 'o_orderkey' AS key_columns, count(*) AS n_rows,
              count(*) - count(o_orderkey) AS n_nulls FROM orders
       UNION ALL SELECT 'conversations', 'conv_id', 1, 1, 'bigint', 'conv_id, turn', count(*),
              count(*) - count(conv_id) FROM conversations
       UNION ALL SELECT 'conversations', 'turn', 2, 2, 'bigint', 'conv_id, turn', count(*),
              count(*) - count(turn) FROM conversations
       UNION ALL SELECT 'part_nokey', 'p_partkey', 1, 1, 'bigint', 'p_partkey', count(*),
              count(*) - count(p_partkey) FROM part_nokey
       UNION ALL SELECT 'lineitem', 'l_linenumber', 4, 1, 'int', 'l_linenumber, l_orderkey', count(*),
              count(*) - count(l_linenumber) FROM lineitem
       UNION ALL SELECT 'lineitem', 'l_orderkey', 1, 2, 'bigint', 'l_linenumber, l_orderkey', count(*),
              count(*) - count(l_orderkey) FROM lineitem""",
    ("part_nokey",),
)
def key_columns(spark, sf):
    """Keys declared in the catalogue, read back in key order, with rows and NULLs counted."""
    entries = {}
    try:
        for name, key in _KEYS.items():
            entry = f"tablesync_{uuid.uuid4().hex}"
            if name in INPUTS:
                path = Scratch(spark).path(name)
                table(spark, sf, name).write.parquet(path)
            else:
                path = f"{sf}/{name}.parquet"
            spark.catalog.createTable(entry, path=path, source="parquet")
            entries[name] = entry
            catalogue.declare_key(spark, entry, key)
        return catalogue.key_columns(spark, entries)
    finally:
        for entry in entries.values():
            spark.sql(f"DROP TABLE {entry}")


@query(
    "state_file_rules",
    """WITH w AS (SELECT CAST(max(o_orderdate) AS VARCHAR) AS top FROM orders),
            c AS (SELECT CAST(max(c_custkey) AS VARCHAR) AS top FROM customer)
       SELECT '1 no file yet' AS step, CAST(NULL AS VARCHAR) AS orders, CAST(NULL AS VARCHAR) AS customer
       UNION ALL SELECT '2 saved side by side', w.top, c.top FROM w, c
       UNION ALL SELECT '3 one file damaged', NULL, c.top FROM c
       UNION ALL SELECT '4 saved again', w.top, c.top FROM w, c""",
)
def state_file_rules(spark, sf):
    """Watermarks in a state file: missing, written in parallel, damaged, written again."""
    path = Scratch(spark).path("state")
    state = StateFile(spark, path)
    tops = {
        "orders": read_summary(table(spark, sf, "orders"), ORDERS.key, "o_orderdate", None).watermark,
        "customer": read_summary(table(spark, sf, "customer"), CUSTOMER.key, "c_custkey", None).watermark,
    }
    rows = []

    def saved(step):
        found = [state.saved(name) for name in tops]
        rows.append((step, *(f.value if f else None for f in found)))

    saved("1 no file yet")
    with ThreadPoolExecutor(len(tops)) as pool:
        list(pool.map(lambda name: state.set(name, tops[name]), tops))
    saved("2 saved side by side")
    files = SharedFiles(spark, path)
    (damaged,) = [name for name in files.names() if "orders" in name]
    files.write_text(damaged, "{not json", True)
    saved("3 one file damaged")
    state.set("orders", tops["orders"])
    saved("4 saved again")
    return spark.createDataFrame(rows, "step string, orders string, customer string")


@query(
    "preview",
    """SELECT *, true AS truncated FROM (
         SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 200)""",
)
def preview(spark, sf):
    return inspect.preview(table(spark, sf, "orders"), ("o_orderdate", "o_orderkey"))


_AD_HOC = """
SELECT n.n_name, count(*) AS n_orders, count(DISTINCT o.o_custkey) AS n_customers,
       max(o.o_orderdate) AS last_order
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""


@query("adhoc_query", _AD_HOC)
def adhoc_query(spark, sf):
    named = {name: table(spark, sf, name) for name in ("orders", "customer", "nation")}
    return inspect.run_sql(spark, _AD_HOC, named)
