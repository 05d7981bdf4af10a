"""Every query of the subpackage over empty tables and over odd rows."""

from __future__ import annotations

import pytest

from papyr.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty_tables, name):
    got = QUERIES[name](spark, empty_tables).collect()
    assert got == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_odd_rows(spark, odd_tables, name):
    df = QUERIES[name](spark, odd_tables)
    got = df.collect()
    assert got
    if name.endswith("_found"):
        assert len(set(map(tuple, got))) == len(got)
