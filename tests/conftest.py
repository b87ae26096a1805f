import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickertide.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    session = get_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": shared},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
