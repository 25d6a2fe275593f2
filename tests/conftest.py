import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from archivekit.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", **{
        "spark.master": "local[8]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        # Tests write many tiny folders: let several tasks share them.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
