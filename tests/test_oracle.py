"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry  # noqa: E402
from bitextloom.catalog import ORACLES, QUERIES  # noqa: E402
from tools.check import compare  # noqa: E402

TABLES = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], TABLES)
    assert verdict.startswith("ok"), verdict
