import os

import pytest

from casebook.oracle import ORACLE
from casebook.queries import QUERIES
from tests.compare import compare, connect

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# An unordered sample has no one right answer.
WITHOUT_SQL = {"sample_extract_orders"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLE)


def test_sample(spark):
    rows = QUERIES["sample_extract_orders"](spark, FOLDER)
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    assert rows.count() == min(1000, orders.count()) and rows.exceptAll(orders).isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], FOLDER) == []
