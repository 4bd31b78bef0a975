"""The corpus queries that SQL can express, against DuckDB."""

import pytest

from seqloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, data, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    found, frame = con.sql(ORACLES[name]), QUERIES[name](spark, data)
    assert sorted(found.columns) == sorted(frame.columns)
    order = sorted(found.columns)
    assert sorted(tuple(r[c] for c in order) for r in frame.fillna(-1).collect()) == sorted(tuple(-1 if v is None else v for v in r) for r in found.select(*order).fetchall())
