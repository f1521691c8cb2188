"""Every query beside its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import workload
from tests.oracle_check import compare, views

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQLS = workload.all_queries(), workload.all_sql()


@pytest.fixture(scope="module")
def oracle():
    return views(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    outcome = compare(spark, oracle, FOLDER, name, QUERIES[name], SQLS.get(name))
    assert outcome.startswith(("ok", "rows only"))
