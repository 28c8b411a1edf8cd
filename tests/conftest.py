from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidestar.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


SMALL = "/root/testdata/sf0.001"


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """The physical plan that Spark starts from."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after AQE has run it to the end."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollectPublic()
    return execution.executedPlan().toString()
