"""Every registered query with an oracle agrees with DuckDB (sf0.001)."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare
from parcelle.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, SF_SMALL, QUERIES[name], ORACLES[name])
    assert not problems, problems


def test_every_query_has_entry():
    import __spark_entry__ as E
    assert set(QUERIES) <= set(E.queries())
    assert set(E.queries()) - set(QUERIES) == set(E._llm()[0])  # empty where those modules are absent
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["type_local", "year", "n_sales", "mean_prix_m2", "median_prix_m2"]
    assert df.count() > 0
