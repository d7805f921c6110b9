import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartwheel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests", 8, **{"spark.checkpoint.dir": shared, "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
