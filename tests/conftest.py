from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from clientlens.workspace import session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    spark = session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(home / "shared"),
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("provided tables are not here")
    return str(folder)


@pytest.fixture(scope="session")
def small() -> str:
    folder = DATA / "sf0.01"
    if not folder.exists():
        pytest.skip("provided tables are not here")
    return str(folder)
