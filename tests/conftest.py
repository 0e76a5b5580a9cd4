import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyspan.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[8]", 8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
