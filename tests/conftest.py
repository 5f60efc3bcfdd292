from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sysledger.session import get_session

    s = get_session("local[8]", app="sysledger-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck as make

    return make(SF_SMALL)


def rows(df):
    return [tuple(r) for r in df.collect()]
