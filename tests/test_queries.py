"""Every query with SQL gives the rows that DuckDB gives for it; the others give rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from paperloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or hasattr(v, "quantize") else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL)))
def test_other_queries_have_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r.coverage for r in rows} <= {1.0, None}
    assert set(entry.oracle_sql()) <= set(entry.queries())
