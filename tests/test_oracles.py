"""Every registered query against its SQL, on the smallest test data."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from verify import compare

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    made = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        made.execute(f"create view {path.stem} as select * from '{path}'")
    return made


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, connection, name):
    line, good = compare(spark, sf, name, ORACLES[name], connection)
    assert good, line


def test_entry(spark):
    assert registry.entry(spark).count() > 0
