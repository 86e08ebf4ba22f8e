"""Queries beside their SQL, on the smallest tables."""

import duckdb
import pytest

from motorpool.llm.oracles import ORACLES
from motorpool.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    relation = con.sql(ORACLES[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    plain = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {f.name: plain[f.dataType.simpleString()] for f in result.schema} == types
    ours = sorted(tuple(r) for r in result.select(*columns).collect())
    assert ours == sorted(relation.select(*columns).fetchall())
