"""All registered queries of the panel against their SQL, on the smallest sample tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF = Path("/root/testdata/sf0.001")
CHECKED = [name for name in registered.queries() if not name.startswith(("op", "pipeline"))]


@pytest.fixture(scope="module")
def tables():
    if not SF.exists():
        pytest.skip("no sample tables")
    connection = duckdb.connect()
    for name in ("lineitem", "part", "supplier", "nation"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    own = {name for name in registered.queries() if not name.startswith(("op", "pipeline"))}
    assert own == {q for q in registered.oracle_sql() if not q.startswith(("op", "pipeline"))}


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, tables, name):
    df = registered.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = tables.execute(registered.oracle_sql()[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    wanted = sorted(
        (tuple(r[order.index(c)] for c in columns) for r in result.fetchall()), key=repr
    )
    assert got == wanted


def test_entry_runs(spark, tables):
    assert registered.entry(spark).count() > 0
