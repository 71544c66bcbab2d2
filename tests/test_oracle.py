"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
import check
import oracle

SF = "/root/testdata/sf0.001"
# Queries of the corpus subpackage, where it is there, have tests of their own.
OWN = [n for n in entry_module.queries() if n not in entry_module._llm()[0]]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def test_every_query_has_a_twin():
    assert set(OWN) <= set(entry_module.queries())
    assert set(OWN) == set(oracle.statements())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, name):
    assert check.compare(spark, SF, name).startswith("ok")


def test_entry_is_ranked_worst_first(spark):
    totals = [r[0] for r in entry_module.entry(spark).where("client = 'C1'").select("`01_TOTL`").collect()]
    assert totals and totals == sorted(totals)
