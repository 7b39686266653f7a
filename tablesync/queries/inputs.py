"""Sources and targets derived from the given tables.

Every text runs unchanged in Spark and in DuckDB and keeps every row of its table.
Rows that exist on one side only come from keys that differ (a negative or shifted
key), never from leaving rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name -> (base table, query over it)
INPUTS: dict[str, tuple[str, str]] = {
    "orders_tgt": (
        "orders",
        """SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
                       THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
                  o_custkey,
                  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
                       ELSE o_orderstatus END AS o_orderstatus,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
                       ELSE o_totalprice END AS o_totalprice,
                  o_orderdate, o_orderpriority
           FROM orders""",
    ),
    "orders_nullwm": (
        "orders",
        """SELECT o_orderkey,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS o_orderdate
           FROM orders""",
    ),
    "orders_text": (
        "orders",
        """SELECT CAST(o_orderkey AS STRING) AS o_orderkey,
                  o_custkey + CAST(0.5 AS DOUBLE) AS o_custkey,
                  o_orderstatus,
                  CAST(o_totalprice AS STRING) AS o_totalprice,
                  CAST(o_orderdate AS STRING) AS o_orderdate,
                  o_orderpriority
           FROM orders""",
    ),
    "customer_src": (
        "customer",
        """SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey
                       ELSE c_custkey END AS c_custkey,
                  c_name, c_nationkey, c_acctbal, c_mktsegment
           FROM customer""",
    ),
    "customer_tgt": (
        "customer",
        """SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey + 1000000000000
                       ELSE c_custkey END AS c_custkey,
                  CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' closed'
                       ELSE c_name END AS c_name,
                  c_nationkey, c_acctbal, c_mktsegment
           FROM customer""",
    ),
    "conversations_src": (
        "conversations",
        """SELECT conv_id, CASE WHEN role = 'system' THEN turn + 1000000 ELSE turn END AS turn,
                  role, text
           FROM conversations""",
    ),
    "part_tgt": (
        "part",
        """SELECT CASE WHEN p_size > 25 THEN -1 - p_partkey ELSE p_partkey END AS p_partkey,
                  p_name,
                  CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS p_brand,
                  CAST(p_size AS STRING) AS p_size,
                  p_name || '/' || p_brand AS local_note
           FROM part""",
    ),
    "part_link": (
        "part",
        """SELECT CASE WHEN p_size > 25 THEN -1 - p_partkey ELSE p_partkey END AS p_partkey,
                  p_name,
                  CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS p_brand,
                  p_name || '/' || p_brand AS local_note
           FROM part""",
    ),
    "part_nokey": (
        "part",
        """SELECT CASE WHEN p_size = 7 THEN NULL ELSE p_partkey END AS p_partkey,
                  p_name, p_brand, p_type, p_size, p_retailprice
           FROM part""",
    ),
    "part_declared": (
        "part",
        """SELECT p_partkey,
                  CASE WHEN p_size < 4 THEN 'BOOLEAN' WHEN p_size < 7 THEN 'datetime'
                       WHEN p_size < 9 THEN 'TIMESTAMPTZ' WHEN p_size < 12 THEN 'date'
                       WHEN p_size < 15 THEN 'NUMERIC(10)'
                       WHEN p_size < 19 THEN 'nvarchar(' || CAST(p_size AS STRING) || ')'
                       WHEN p_size < 22 THEN 'BIGINT UNSIGNED' WHEN p_size < 25 THEN 'POINT'
                       WHEN p_size < 28 THEN 'double' WHEN p_size < 31 THEN 'BLOB'
                       WHEN p_size < 34 THEN '' WHEN p_size < 36 THEN NULL
                       WHEN p_size < 38 THEN 'JSON' WHEN p_size < 40 THEN 'VARBINARY'
                       WHEN p_size < 45 THEN 'Decimal( ' || CAST(p_size AS STRING) || ' , 2 )'
                       ELSE p_type END AS declared
           FROM part""",
    ),
    "documents_flags": (
        "documents",
        """SELECT doc_id,
                  n_chars - 1000 AS flag_int,
                  CASE WHEN lang = 'en' THEN CAST(0 AS DOUBLE) ELSE n_chars / 7.0 END AS flag_real,
                  CASE source WHEN 'src0' THEN 'on' WHEN 'src1' THEN ' YES '
                              WHEN 'src2' THEN 'off' WHEN 'src3' THEN '2' WHEN 'src4' THEN ''
                              WHEN 'src5' THEN 'T' WHEN 'src6' THEN NULL ELSE text END AS flag_text
           FROM documents""",
    ),
    "events_tgt": (
        "events",
        """SELECT CASE WHEN event_type = 'view' THEN -1 - event_id ELSE event_id END AS event_id,
                  ts, user_id, event_type,
                  CASE WHEN value > 10 THEN NULL ELSE value END AS value, props
           FROM events""",
    ),
    "embeddings_tgt": (
        "embeddings",
        """SELECT vec_id, CASE WHEN label < 3 THEN NULL ELSE embedding END AS embedding, label
           FROM embeddings""",
    ),
    "lineitem_tgt": (
        "lineitem",
        """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey,
                  max(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity
           FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    ),
    "lines_taken": (
        "orders",
        """SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, o_custkey AS l_partkey,
                  o_orderdate AS l_shipdate, CAST(NULL AS BIGINT) AS l_suppkey,
                  o_totalprice AS l_extendedprice
           FROM orders""",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a derived input by its name."""
    if name not in INPUTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base, query = INPUTS[name]
    table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(query)


def with_inputs(query: str, *names: str) -> str:
    """DuckDB query text with the derived inputs as common table expressions."""
    if not names:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({INPUTS[n][1]})" for n in names) + "\n" + query
