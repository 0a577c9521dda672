"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from rillwork.plans import REGISTRY

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = {k: q for k, q in entry.queries().items() if k in REGISTRY}, entry.oracle_sql()
# Their windows or limits may leave nothing on so few rows.
MAY_BE_EMPTY = {"blacklist_alarms", "interval_join", "interval_join_stream", "late_side_output", "login_fail_pattern"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, con, key):
    problem = compare(spark, con, FOLDER, key, QUERIES[key], SQL.get(key))
    assert problem is None or (problem == "both empty" and key in MAY_BE_EMPTY)


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"window_end", "item_id", "clicks", "rank"}


def test_only_approximate_queries_have_no_sql():
    assert set(QUERIES) - set(SQL) == {"uv_approx", "uv_sketch_sliding", "uv_sketch_stream"}
