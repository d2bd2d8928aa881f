import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tollgate.session import build_session  # noqa: E402
from tollgate.sources.shared import remove_run_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_sql_warehouse_dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_run_folder(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
