"""Every registered query that has an oracle equals it on the small tables."""

import duckdb
import pytest

from tidewell import queries as own

SF_DIR = "/root/testdata/sf0.01"
TABLES = "customer orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_meets_its_oracle(spark, duck, name):
    frame = own.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = sorted((tuple(map(str, r)) for r in frame.select(*columns).collect()))
    want = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({own.oracle_sql()[name]})").fetchall()
    assert got == sorted(tuple(map(str, r)) for r in want) and got


def test_every_query_has_an_oracle():
    rest = set(own.queries()) - set(own.oracle_sql())
    assert rest == set()
