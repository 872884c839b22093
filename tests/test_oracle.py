"""Every registered query against its SQL twin in DuckDB at sf0.001."""

import pytest

import __spark_entry__ as E
from check_oracle import compare
from tessera.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry()[0])


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["q_id", "label", "predicted"]


def test_every_query_has_sql_or_reason():
    no_sql = set(NAMES) - set(E.oracle_sql())
    assert not no_sql


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rep = compare(spark, SF, [name], verbose=False)[name]
    assert rep.get("ok") is not False, rep
