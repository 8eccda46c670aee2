"""Queries with an SQL form against DuckDB."""

import duckdb
import pytest

from conftest import SF001
from parcelkit.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF001).toPandas()
    want = con.execute(queries.ORACLE[name]).df()[list(got.columns)]
    rows = lambda df: sorted(map(tuple, df.itertuples(index=False)))
    assert rows(got) == rows(want)
