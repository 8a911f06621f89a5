"""Every corpus query that SQL can express, against its SQL on whole tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows
from conftest import SF_ORACLE

from tidewatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, SF_ORACLE))
    assert got[0]
    assert difference(got, sql_rows(connect(SF_ORACLE), ORACLES[name])) is None


def test_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
