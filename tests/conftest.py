import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewatch.session import local_session

    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        **{
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    yield session
    session.stop()
