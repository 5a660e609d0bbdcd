"""Every query of the library against its SQL in DuckDB."""

import duckdb
import pytest

from weftline.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("nation", "supplier", "orders", "events", "documents", "conversations"):
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_same_rows(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    want = con.sql(catalog.oracle_sql()[name])
    columns, names = sorted(df.columns), want.columns
    assert columns == sorted(names)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["chat_id", "turn", "message_no", "message"]
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
