"""Every registered query against its SQL oracle."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check_oracle import compare, connect

import __spark_entry__ as contract
from tidestar.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_oracle_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLE:
        assert compare(df, duck, ORACLE[name])[0] == "ok"
    else:
        assert df.count() > 0


def test_only_random_rows_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"sample_n"}


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 3
