from __future__ import annotations

import os

import pytest

from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"gbt_forecast", "gbt_fairness"}


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    types = {row[0]: row[1] for row in con.execute(f"describe {ORACLE[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns, rows = spark_rows(df)
    expected_columns, expected = duck_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected
