"""Every registered query against its SQL on the same tables, in full."""

import duckdb
import pytest

from __spark_entry__ import entry
from kinweave.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return float(value)
        return value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.collect(), df.columns)
    if name not in SQL:
        assert got
        return
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(result.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_only_the_approximate_search_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"h5_approximate_topk"}
