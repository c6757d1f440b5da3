"""Every registered query against its SQL twin on the driver tables."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck
from tabprep.plans import catalog

ORACLES = {name: sql for name, (_, sql) in catalog.REGISTRY.items() if sql is not None}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    assert compare(df, con, ORACLES[name]) == []


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "validation", "test"}


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.queries()) == set(E.oracle_sql()) | set(E.ROWS_ONLY)
    assert set(catalog.REGISTRY) <= set(E.queries())
    assert set(catalog.REGISTRY) - set(ORACLES) == {"synth_copula", "train_score_gate"}
