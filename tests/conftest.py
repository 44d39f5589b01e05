from __future__ import annotations

import pytest

from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test: ``settings(**{name: value})``."""
    changed = {}

    def apply(**options):
        for name, value in options.items():
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield apply
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
