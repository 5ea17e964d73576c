"""Queries of the subpackage against their SQL, and the SQL against other parameters where the tables hold too few cases."""

import duckdb
import pytest

from veilwork.llm import embedding_dedup, queries

TABLES = "documents embeddings conversations".split()


def rows_of(spark, sf_dir, df, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in names)) for r in df.collect()), sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    got, want = rows_of(spark, "/root/testdata/sf0.001", queries.QUERIES[name](spark, "/root/testdata/sf0.001"), queries.SQL[name])
    assert got == want and got


@pytest.mark.parametrize("threshold", [0.2, 0.35])
def test_embedding_links_where_there_are_many(spark, threshold):
    sf_dir = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    sql = queries.SQL["op1_embedding_near_dedup"]
    assert sql.count("0.98") == 1
    got, want = rows_of(spark, sf_dir, embedding_dedup.near_duplicates(vectors, threshold, tile=16), sql.replace("0.98", str(threshold)))
    assert got == want and any(", False, " in r for r in got)
