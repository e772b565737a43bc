"""Driver contract: entry smoke, registry consistency, oracle agreement at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["bin_class", "term", "score", "rank"]
    assert df.count() > 0


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("test tables missing")
    con = duck(SF)
    ok, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert ok, detail
