"""Every registered query against its SQL on the same tables, and a look at its plan."""

import contextlib
import io

import oracle
import pytest
from __spark_entry__ import entry

from brookmark.workload import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain()
    return text.getvalue()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert oracle.difference(df, con, ORACLES[name]) is None
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_entry_is_the_star_query(spark):
    assert entry(spark).columns == ["calendar_year", "month_name", "category", "revenue"]
