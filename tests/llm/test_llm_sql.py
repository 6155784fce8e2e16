"""The operators that SQL can express, against their DuckDB answers."""

import duckdb
import pytest
from conftest import TESTDATA

from martline.llm.queries import QUERIES
from martline.llm.sql import SQL

NAMES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(TESTDATA))
    answer = db.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    assert {f.name: NAMES[f.dataType.simpleString()] for f in df.schema} == types
    columns = sorted(types)
    place = {d[0]: i for i, d in enumerate(answer.description)}
    expected = sorted((tuple(r[place[c]] for c in columns) for r in answer.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected
