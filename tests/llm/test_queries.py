"""Every registered operator query against its SQL, on the smallest tables."""

import contextlib
import io
from pathlib import Path

import duckdb
import pytest

from tallystar.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not on this machine")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((x is None, x or 0) for x in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, oracle, name):
    printed = io.StringIO()
    frame = QUERIES[name](spark, str(SF))
    with contextlib.redirect_stdout(printed):
        frame.explain()
    assert "CartesianProduct" not in printed.getvalue()
    cursor = oracle.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert ordered(tuple(r) for r in frame.select(*names).collect()) == ordered(cursor.fetchall())


def test_ten_and_three_operators_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
