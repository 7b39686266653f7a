"""SQLite files, other readers, and the statements of the relational sink."""

from __future__ import annotations

import sqlite3

import duckdb
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tablesync import RelationalTarget, StateFile, SyncOptions, TableSpec, sync_table
from tablesync.sources.readers import full_scan, jdbc_options, read_files, read_table
from tablesync.operators.watermark import Watermark
from tablesync.sources.relational import delete_statement, merge_statement
from tablesync.sources.sqlite import (
    SqliteReader,
    cell_converter,
    read_sqlite,
    sqlite_spec,
    table_info,
)
from tablesync.functions.declared_types import spark_type


@pytest.fixture
def sqlite_file(tmp_path):
    path = str(tmp_path / "source.db")
    db = sqlite3.connect(path)
    db.executescript(
        """
        CREATE TABLE item (id INTEGER PRIMARY KEY, n TEXT, b BLOB, u DATETIME, f BOOLEAN,
                           d DECIMAL(10,2), day DATE, x REAL, "odd ""name" INT);
        CREATE TABLE pair (b TEXT, a INTEGER, v TEXT, PRIMARY KEY (a, b)) WITHOUT ROWID;
        CREATE TABLE nokey (v TEXT);
        """
    )
    rows = [
        (i * 3, f"n{i}", b"\x00" * (i % 3), f"2024-01-{1 + i % 28:02d} 10:00:00",
         (0, 1, "on", "off", None)[i % 5], 1.005 * i, "2024-02-03", i / 2, i)
        for i in range(1, 501)
    ]
    rows.append((5000, 17, "text", None, 2, "3.14", None, "2.5", "7"))
    db.executemany("INSERT INTO item VALUES (?,?,?,?,?,?,?,?,?)", rows)
    db.executemany(
        "INSERT INTO pair VALUES (?,?,?)", [(f"k{i % 7}", i // 7, str(i)) for i in range(200)]
    )
    db.commit()
    db.close()
    return path


def test_sqlite_rows_and_types(spark, sqlite_file):
    df = read_sqlite(spark, sqlite_file, "item", 4)
    assert [f.dataType.simpleString() for f in df.schema] == [
        "bigint", "string", "binary", "timestamp_ntz", "boolean", "decimal(10,2)", "date",
        "double", "bigint",
    ]
    assert df.count() == 501 and df.select("id").distinct().count() == 501
    odd = df.where("id = 5000").first()
    assert (odd.n, bytes(odd.b), odd.u, odd.f, str(odd.d), odd.x) == (
        "17", b"text", None, True, "3.14", 2.5,
    )
    flags = {r.f: r.n for r in df.where("id < 5000").groupBy("f").agg(F.count("*").alias("n")).collect()}
    assert flags == {False: 200, True: 200, None: 100}
    assert df.rdd.getNumPartitions() == 4


def test_sqlite_without_rowid(spark, sqlite_file):
    assert table_info(sqlite_file, "pair").key == ("a", "b")
    df = read_sqlite(spark, sqlite_file, "pair", 5)
    expected = sorted((f"k{i % 7}", i // 7, str(i)) for i in range(200))
    assert sorted(tuple(r) for r in df.collect()) == expected


def test_sqlite_guards(spark, sqlite_file, tmp_path):
    missing = tmp_path / "absent.db"
    with pytest.raises(FileNotFoundError):
        read_sqlite(spark, str(missing), "item")
    assert not missing.exists()
    with pytest.raises(FileNotFoundError):
        table_info(str(tmp_path), "item")
    with pytest.raises(ValueError, match="no table"):
        table_info(sqlite_file, "nothing")
    with pytest.raises(ValueError, match="primary key"):
        sqlite_spec(sqlite_file, "nokey")
    for value in (b"x", 5):
        with pytest.raises(ValueError):
            cell_converter(spark_type("TEXT" if value == b"x" else "BLOB"))(value)


def test_sqlite_pushed_filters_only_widen(spark, sqlite_file):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    df = read_sqlite(spark, sqlite_file, "item", 2)
    assert df.where("x >= 200").count() == 101
    assert df.where("n >= 'n99'").count() == 1 and df.where("n = '17'").count() == 1
    reader = SqliteReader({"path": sqlite_file, "table": "item"}, df.schema)
    kept = reader.pushFilters([GreaterThanOrEqual(("x",), 200.0), EqualTo(("f",), True)])
    assert len(kept) == 2 and len(reader.conditions) == 1
    read = sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))
    assert 101 <= read < 501


def test_sqlite_to_target(spark, sqlite_file, new_target):
    spec = sqlite_spec(sqlite_file, "item")
    source = read_sqlite(spark, sqlite_file, "item", 3).drop('odd "name')
    target = new_target()
    target.create(spec, source.schema)
    options = SyncOptions(incremental_col="u", source_key_is_unique=True)
    first = sync_table(spark, spec, source, target, options)
    assert (first.read_rows, first.affected_rows, first.watermark) == (501, 501, "2024-01-28 10:00:00")
    db = sqlite3.connect(sqlite_file)
    db.execute("UPDATE item SET n = 'new', u = '2024-03-01 00:00:00' WHERE id = 3")
    db.execute("UPDATE item SET n = 'unseen' WHERE id = 6")
    db.commit()
    db.close()
    second = sync_table(spark, spec, source, target, options)
    assert second.affected_rows == 1 and second.watermark == "2024-03-01 00:00:00"
    assert target.load().where("id = 3").first().n == "new"


def test_file_and_table_readers(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    with pytest.raises(FileNotFoundError):
        read_files(spark, path)
    spark.range(5).withColumn("b", F.lit(1)).write.parquet(path)
    assert full_scan(read_files(spark, path), ["b", "id"]).columns == ["b", "id"]
    with pytest.raises(ValueError):
        read_table(spark, "no_such_table")
    spark.range(3).createOrReplaceTempView("linked_rows")
    assert read_table(spark, "linked_rows").count() == 3


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x", "t", "k", (0, 100), 8)
    assert split["numPartitions"] == "8" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="k")


def test_relational_statements():
    """The statements in an engine that runs MERGE: prune first, then the rest."""
    db = duckdb.connect()
    db.execute("CREATE TABLE t (k INT PRIMARY KEY, v VARCHAR, note VARCHAR)")
    db.execute("INSERT INTO t VALUES (1, 'a', 'n1'), (2, 'b', 'n2'), (3, 'c', 'n3')")
    db.execute("CREATE TABLE t__changes (__op VARCHAR, k INT, v VARCHAR)")
    db.execute(
        "INSERT INTO t__changes VALUES ('update', 1, NULL), ('prune', 2, NULL), ('insert', 4, 'b')"
    )
    db.execute(delete_statement("t", "t__changes", ["k"]))
    db.execute(merge_statement("t", "t__changes", ["k"], ["k", "v"]))
    rows = sorted(db.execute("SELECT * FROM t").fetchall())
    assert rows == [(1, None, "n1"), (3, "c", "n3"), (4, "b", None)]
    key_only = merge_statement("s.t", "s.t__changes", ["k"], ["k"])
    assert "UPDATE" not in key_only and '"s"."t"' in key_only


class InProcessTarget(RelationalTarget):
    """The relational target over an in-process engine instead of JDBC."""

    def __init__(self, spark, spec, db, **more):
        super().__init__(spark, spec, "none", **more)
        self.db = db

    def _read(self):
        info = self.db.execute(f"DESCRIBE {self.table}").fetchall()
        kinds = {"INTEGER": "int", "VARCHAR": "string", "BIGINT": "bigint", "BOOLEAN": "boolean"}
        schema = ", ".join(f"{name} {kinds[kind]}" for name, kind, *_ in info)
        rows = self.db.execute(f"SELECT * FROM {self.table}").fetchall()
        return self.spark.createDataFrame(rows, schema)

    def _write_staging(self, rows, staging):
        frame = rows.toPandas()  # noqa: F841 - read by name below
        self.db.execute(f'CREATE TABLE "{staging}" AS SELECT * FROM frame')

    def _transaction(self, statements):
        self.db.execute("BEGIN")
        try:
            for text in statements:
                self.db.execute(text)
            self.db.execute("COMMIT")
        except Exception:
            self.db.execute("ROLLBACK")
            raise


def test_runs_against_a_relational_target(spark, tmp_path):
    db = duckdb.connect()
    db.execute(
        "CREATE TABLE t (k INTEGER PRIMARY KEY, v VARCHAR, ts BIGINT, note VARCHAR DEFAULT 'new')"
    )
    db.execute("INSERT INTO t VALUES (1, 'a', 1, 'n1'), (2, 'b', 1, 'n2'), (3, 'c', 1, 'n3')")
    spec = TableSpec("t", "k", unique_keys=(("v",),), identity=("k",))
    state = StateFile(spark, str(tmp_path / "state"))
    target = InProcessTarget(spark, spec, db, state=state)
    rows = lambda: sorted(db.execute("SELECT * FROM t").fetchall())
    schema = "k int, v string, ts bigint"

    # Key 9 takes over the value of key 2, which prune removes first.
    source = spark.createDataFrame([(1, "A", 2), (3, "c", 1), (9, "b", 5)], schema)
    options = SyncOptions(
        prune=True, allow_prune=True, incremental_col="ts", sync_sequence=True
    )
    report = sync_table(spark, spec, source, target, options)
    assert (report.read_rows, report.affected_rows, report.deleted_rows) == (3, 2, 1)
    assert report.sequences == {"k": 9} and report.target_only == ("note",)
    assert rows() == [(1, "A", 2, "n1"), (3, "c", 1, "n3"), (9, "b", 5, "new")]
    assert state.get("t", "ts") == Watermark("ts", "bigint", "5")

    # A clash, found before the database is touched.
    clash = spark.createDataFrame([(10, "A", 6)], schema)
    with pytest.raises(Exception, match="unique"):
        sync_table(spark, spec, clash, target, SyncOptions(incremental_col="ts"))
    assert len(rows()) == 3 and state.get("t", "ts").value == "5"

    # A new column, and only rows since the watermark.
    wide = spark.createDataFrame(
        [(1, "late", 2, True), (11, "x", 5, True)], schema + ", flag boolean"
    )
    more = SyncOptions(incremental_col="ts", add_columns=True)
    report = sync_table(spark, spec, wide, target, more)
    assert report.affected_rows == 1 and report.added_columns == {"flag": "boolean"}
    assert rows()[-1] == (11, "x", 5, "new", True) and rows()[0] == (1, "A", 2, "n1", None)
    assert sync_table(spark, spec, wide, target, more).affected_rows == 0
    tables = [r[0] for r in db.execute("SHOW TABLES").fetchall()]
    assert tables == ["t"]

    inserted = spark.createDataFrame([(1, "zz", 9), (12, "x", 9), (13, "y", 9)], schema)
    report = sync_table(spark, spec, inserted, target, SyncOptions(insert_only=True))
    assert report.affected_rows == 1 and rows()[-1][0] == 13
