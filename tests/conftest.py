from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONPATH", str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strandloom.session import session

    made = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('scratch')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


def rows(df):
    """All rows as sorted tuples."""
    found = [tuple(r) for r in df.collect()]
    try:
        return sorted(found)
    except TypeError:  # nulls
        return sorted(found, key=repr)
