"""The queries of this subpackage against their SQL in DuckDB."""

import duckdb
import pytest

from weftline.llm import oracles, queries


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_rows(spark, name, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    df = queries.queries()[name](spark, f"/root/testdata/{sf}")
    want = con.sql(oracles.oracle_sql()[name])
    columns, names = sorted(df.columns), want.columns
    assert columns == sorted(names)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall()), key=repr)
