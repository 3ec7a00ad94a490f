"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from marlstone.plans import rule_queries  # noqa: F401  (registers more queries)
from marlstone.plans.catalog import ORACLE_SQL, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else "[" + ",".join(map(plain, value)) + "]" if isinstance(value, list | tuple) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    assert rows == sorted(tuple(map(plain, r)) for r in want.project(",".join(f'"{c}"' for c in columns)).fetchall())
