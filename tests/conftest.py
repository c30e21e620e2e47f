from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from abacarium.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "abacarium-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="100000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    from shop import tables

    return tables(spark)


@pytest.fixture(scope="session")
def star(spark):
    from star import tables

    return tables(spark)
