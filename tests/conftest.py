import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import get_spark
    s = get_spark("local[4]", app="shoplens-tests", shuffle_partitions=4, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shoplens-test-ckpt-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shoplens-test-wh-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="shoplens-test-")
