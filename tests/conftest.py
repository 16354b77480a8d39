import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bizpulse.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__sql__shuffle__partitions": "4",
        "spark__sql__warehouse__dir": tempfile.mkdtemp(prefix="warehouse-"),
    }
    session = build_session("tests", master="local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def rows(df, *sort):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
