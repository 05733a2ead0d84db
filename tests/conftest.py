import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.session import build_session, shared_root  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="4", spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false", spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_root(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not TESTDATA.exists():
        pytest.skip("test data is not available")
    return str(TESTDATA)
