"""Registered queries against their SQL, on the smallest data folder."""

import functools
import os

import pytest

import __spark_entry__ as entry
import compare
from cohortloom.checks import registry, table_checks
from cohortloom.checks.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"
load_dimensions = table_checks._dimensions
NAMES = list(registry.all_queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def dimensions():
    """Load the dimensions once for all load queries of this file; the queries themselves do not."""
    patch = pytest.MonkeyPatch()
    once = functools.cache(lambda spark, folder: load_dimensions(Inputs(spark, folder)))
    patch.setattr(table_checks, "_dimensions", lambda x: once(x.spark, x.folder))
    yield
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    assert compare.compare(spark, connection, FOLDER, name) == ""


def test_every_query_has_sql():
    assert set(NAMES) == set(registry.all_sql())
    assert set(NAMES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "drug_era_id"
