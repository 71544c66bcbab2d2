"""Queries that SQL can express, against DuckDB."""

import os

import pytest

import check
from common import SF
from stockrecon.llm import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, SF, name).startswith("ok")


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
