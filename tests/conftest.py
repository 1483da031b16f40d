import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.inputs import new_prefix
from strataline.plans.lake import Lake
from strataline.session import session


@pytest.fixture(scope="session")
def spark():
    made = session(
        "strataline-tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), new_prefix(), buckets=4).create()


@pytest.fixture
def landing(tmp_path):
    """Write text files into a landing folder, with a set modification time."""
    import os

    def put(name, text, modified=None):
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text) if isinstance(text, str) else path.write_bytes(text)
        if modified is not None:
            os.utime(path, (modified, modified))
        return str(path)

    put.folder = str(tmp_path / "landing")
    return put
