import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (ROOT, ROOT / "tests"):
    if str(p) not in sys.path:
        sys.path.insert(0, str(p))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from beaconry.session import get_session

    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
