"""Queries that have an SQL form, against DuckDB."""

import os

import duckdb
import pytest

from loam.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, expected = QUERIES[name](spark, SF), db.execute(ORACLES[name])
    columns = sorted(got.columns)
    names = [c[0] for c in expected.description]
    assert sorted(names) == columns
    wanted = [tuple(r[names.index(c)] for c in columns) for r in expected.fetchall()]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(wanted)
