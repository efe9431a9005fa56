"""Every corpus query with SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from eventloom.llm.queries import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_equals_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    base = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        base.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want = base.sql(CHECKS[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def plain(frame):
        frame = frame[columns].astype(object)
        return sorted(map(str, frame.where(frame.notna(), None).values.tolist()))

    assert plain(got) == plain(want)
    assert len(got)
