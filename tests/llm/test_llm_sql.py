"""The SQL of the operators that have one, against their queries on the smallest tables."""

import os

import pytest

from ledgerloom.llm import registry

DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = pytest.importorskip("duckdb").connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    cursor = con.execute(registry.ORACLE_SQL[name])
    have = [d[0] for d in cursor.description]
    assert sorted(have) == columns
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted((tuple(plain(r[have.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == want
