from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from leadloom.session import clear_staged, local_session  # noqa: E402

DATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "leadloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def medium() -> str:
    return str(DATA / "sf0.01")


@pytest.fixture
def conf(spark):
    """Set session options for one test: ``conf(**{"spark.sql...": value})``."""
    changed: dict[str, str | None] = {}

    def set_options(options: dict[str, str]) -> None:
        for key, value in options.items():
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_options
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
