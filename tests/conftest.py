import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from weblake.session import build_session

    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.local.dir": tempfile.mkdtemp(prefix="weblake-test-local-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="weblake-test-")


def lines_df(spark, rows):
    """[(log_type, message)] -> DataFrame(message, log_type)."""
    return spark.createDataFrame([(m, t) for t, m in rows], "message string, log_type string")
