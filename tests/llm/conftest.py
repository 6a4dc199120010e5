from __future__ import annotations

import duckdb
import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns on request."""

    def make(*rows, extra: tuple[str, ...] = ()):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows
        ]
        df = spark.createDataFrame(full, DOCUMENT)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def as_sql():
    """Rows of DuckDB SQL over Spark tables, columns in the order of their names."""

    def run(sql: str, **tables):
        connection = duckdb.connect()
        for name, df in tables.items():
            if name == "documents":  # extra columns may clash with names in the SQL
                df = df.select("doc_id", "text", "lang", "source", "n_chars")
            connection.register(f"_{name}", df.toArrow())
            connection.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
        result = connection.execute(sql)
        names = [d[0] for d in result.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted((tuple(row[k] for k in order) for row in result.fetchall()), key=repr)

    return run


def by_name(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
