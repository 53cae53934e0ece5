"""Queries against their SQL, and what is registered."""

from __future__ import annotations

import re

import pytest

from tests.oracle import connect, difference
from tickloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES] == list(range(1, 14))
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(LLM_QUERIES[name](spark, SMALL), connect(SMALL), LLM_ORACLES[name]) is None
