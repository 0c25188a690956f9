import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from hearthline.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
