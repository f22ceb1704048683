import re

import pytest

import __spark_entry__ as entry
from oracle_check import compare
from streammetrics.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, name):
    problems, n, _ = compare(spark, duck, name, LLM_QUERIES[name], entry.oracle_sql()[name], SMALL)
    assert not problems, problems
    assert n > 0
