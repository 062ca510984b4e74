import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from offerloom.session import build_session, share_package

    session = build_session(
        "local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g", spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield share_package(session)
    session.stop()
