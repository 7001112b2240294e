import duckdb
import pytest

import __spark_entry__ as entry
from quern import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(x):
    if x is None or x != x:
        return "null"
    return f"{x:.6g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(f"CREATE TABLE r AS {catalog.ORACLES[name]}")
    assert sorted(c[0] for c in con.execute("SELECT * FROM r LIMIT 0").description) == columns
    rows = con.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + " FROM r").fetchall()
    assert got == sorted(tuple(map(shown, r)) for r in rows)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["uid"] and df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
