from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from vendaval.plans.layout import Layout  # noqa: E402
from vendaval.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    started = session("tests", settings)
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "shop"))
