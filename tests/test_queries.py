"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as contract
from tablesync.queries.inputs import INPUTS
from tablesync.queries.registry import ORACLES, QUERIES
from tools.check_oracles import bag


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF001).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF001)
    got = bag(df.columns, df.collect())
    answer = db.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == bag(columns, answer.fetchall())


def test_every_query_is_registered_with_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() >= 1500


@pytest.mark.parametrize("name", sorted(n for n in INPUTS if n != "lineitem_tgt"))
def test_derived_inputs_keep_every_row(db, name):
    base, text = INPUTS[name]
    derived = db.execute(f"SELECT count(*) FROM ({text})").fetchone()
    assert derived == db.execute(f"SELECT count(*) FROM {base}").fetchone()
