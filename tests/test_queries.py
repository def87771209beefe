"""Every registered query against its SQL, on the smallest tables."""

import pytest
from check_queries import compare, duck

import __spark_entry__ as entry
from emberlog.plans import REGISTRY

@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


# the training-data queries are tested in tests/llm
@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    if not ok and note.startswith("0 rows"):
        pytest.skip("no rows at this scale")
    assert ok, note


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.columns == ["service_name", "day", "events", "anomalies", "mean_error_rate"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
