"""Every registered query against its DuckDB SQL on the smallest driver tables
(the driver repeats this at sf0.01)."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare
from vantage.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, names=list(QUERIES), verbose=False)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns[0] == "viewpoint_id" and df.count() > 0


def test_every_query_has_sql():
    import __spark_entry__ as E

    assert set(QUERIES) <= set(E.oracle_sql())


def test_all_queries_match(results):
    bad = {k: v for k, v in results.items() if not (v == "OK" or v.startswith("rows-only"))}
    assert not bad
