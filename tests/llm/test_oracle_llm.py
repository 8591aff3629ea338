"""The queries that have SQL, in DuckDB and in Spark over the same tables."""
import os

import duckdb
import pytest

from sensorlake.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got, want = registry.queries()[name](spark, SF).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    tidy = lambda df: sorted([tuple(None if x != x else x for x in r) for r in df[columns].itertuples(index=False, name=None)], key=repr)
    assert tidy(got) == tidy(want)
