from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cartwise.session import build_session

    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """A frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())
