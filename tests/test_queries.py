"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import check
from hearthline import registry
from hearthline.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(ORACLE)
    assert set(registry.QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, name):
    outcome = check.compare(spark, SF_DIR, name)
    assert not outcome.startswith("FAILED"), outcome


def test_no_listing_column_is_null_throughout(spark):
    rows = registered.queries()["parse_all_columns"](spark, SF_DIR)
    counts = rows.agg(*[F.count(f"`{name}`").alias(name) for name in rows.columns]).first()
    assert len(rows.columns) == 44 and all(counts)
