"""Every registered key with an oracle must equal its DuckDB twin (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from martlens.registry import queries
from martlens.testing import compare, duck_connect

SF = os.environ.get("MARTLENS_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(queries())
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_key_has_oracle_or_is_documented():
    missing = [k for k in KEYS if k not in ORACLE]
    assert missing == [], missing


@pytest.mark.parametrize("key", [k for k in KEYS if k in ORACLE])
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = compare(df, con, ORACLE[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns
