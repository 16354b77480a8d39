"""Corpus queries next to their SQL in DuckDB."""

import pytest
from conftest import SF

import __spark_entry__ as driver
from bizpulse.llm import queries
from checks.compare import digest, duck


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_agrees_with_sql(spark, name):
    df = queries.queries()[name](spark, SF)
    result = duck(SF).execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert digest(df.columns, df.collect()) == digest(columns, result.fetchall())


def test_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(driver.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 14)}
