"""Registered queries: names, SQL oracles on the given tables."""

from __future__ import annotations

import re

import pytest
from check_oracles import compare, database

import __spark_entry__
from faultline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    found = __spark_entry__.queries()
    numbers = sorted(int(m[1]) for name in found if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14)) and "pipeline" in found
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF), database(SF), ORACLES[name]) is None
