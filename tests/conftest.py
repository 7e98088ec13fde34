import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marshlight.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, shuffle_partitions=4, **{
        "spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
