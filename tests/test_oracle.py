"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as repo
import oracle
from roadlake.catalog.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, db, name):
    frame = repo.queries()[name](spark, sf_dir)
    assert oracle.differences(frame, db, ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(repo.queries())


def test_entry(spark):
    assert repo.entry(spark).count() > 0
