"""Every text query with SQL against that SQL, on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from martloom.llm import registry

TABLES = "documents embeddings pages benchmark labels conversations".split()


def _sortable(row):
    return tuple((value is None, "" if value is None else value) for value in row)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for x in TABLES:
        con.sql(f"CREATE VIEW {x} AS SELECT * FROM '{sf_dir}/{x}.parquet'")
    got = registry.queries()[name](spark, sf_dir)
    columns = ", ".join(f'"{c}"' for c in sorted(got.columns))
    want = con.sql(f"SELECT {columns} FROM ({registry.oracle_sql()[name]})").fetchall()
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    assert sorted(rows, key=_sortable) == sorted(want, key=_sortable)
