"""The driver contract, and a cross-section of the catalogue against DuckDB on the smallest tables.

``check_catalogue.py`` compares every query.
"""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from catalogue import registry
from check_catalogue import compare

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "clean_strings",
    "money_columns",
    "silver_enrollments",
    "dim_student",
    "lookup_keys_hot_values",
    "scd2_merge",
    "incremental_merge",
    "dq_references",
    "lake_batches",
    "academic_mart",
)

needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not available")


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["semester_key", "department_key"] and df.count() > 0


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, name):
    agrees, detail = compare(spark, FOLDER, name)
    assert agrees, detail
