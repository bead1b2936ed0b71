"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from millrace.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# What these look for does not occur in so few rows.
EMPTY_ON_SMALL_TABLES = {"filtered_global_sort", "price_threshold"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_oracles_name_registered_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, plan, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # Everything stays on the JVM but for the two items that are about Python.
    assert "EvalPython" not in text or name == "age_band_by_udf"
    assert "MapInPandas" not in text or name == "batches_through_python"
    got = df.toPandas()
    if name in ORACLES:
        problem = differences(got, con.execute(ORACLES[name]).df())
        assert problem is None or name in EMPTY_ON_SMALL_TABLES and problem == "no rows on either side"
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
