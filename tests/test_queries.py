"""Every registered query runs; those with SQL agree with it."""

import os

import pytest
from oracle import connect, difference

from lexloom.plans import corpus_queries, format_queries, layout_queries, lexicon_queries

SF = "/root/testdata/sf0.001"
PLANS = (corpus_queries, lexicon_queries, layout_queries, format_queries)
ALL = [(p, n) for p in PLANS for n in p.QUERIES]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("plan,name", ALL, ids=[n for _, n in ALL])
def test_query(spark, con, plan, name):
    df = plan.QUERIES[name](spark, SF)
    if name in plan.SQL:
        assert difference(df, plan.SQL[name], SF, con) == ""
    else:
        assert df.count() > 0 and df.columns


def test_names_are_unique():
    names = [n for _, n in ALL]
    assert len(names) == len(set(names))


def test_entry_without_the_llm_folder():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {n for _, n in ALL} <= set(e.queries())
