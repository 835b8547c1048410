"""Every registered query against its SQL, on the smallest tables."""

import contextlib
import io
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tallystar.catalog import ORACLES, QUERIES
from tallystar.plans.roles import star

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
    frame = QUERIES[name](spark, str(SF))
    cursor = oracle.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    expected = ordered(cursor.fetchall())
    found = ordered(tuple(row) for row in frame.select(*names).collect())
    assert found == expected
    types = [{type(v) for v in column} - {type(None)} for column in zip(*found, strict=True)]
    wanted = [{type(v) for v in column} - {type(None)} for column in zip(*expected, strict=True)]
    assert types == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"publish_manifest", "gate_publish", "export_rows"}))
def test_no_query_pairs_everything_with_everything(spark, name):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        QUERIES[name](spark, str(SF)).explain()
    plan = printed.getvalue()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "Python" not in plan


def test_publication(spark):
    manifest = {r["table_name"]: r for r in QUERIES["publish_manifest"](spark, str(SF)).collect()}
    built = star(spark, str(SF))
    assert len(manifest) == 19
    assert all(r["has_bytes"] for r in manifest.values())
    assert manifest["fact_housing_activity"]["n_rows"] == built["fact_housing_activity"].count()
    outcome = QUERIES["gate_publish"](spark, str(SF)).orderBy("version").collect()
    assert [(r["version"], r["published"], r["in_force"]) for r in outcome] == [
        ("clean", True, "clean"), ("defective", False, "clean")
    ]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
