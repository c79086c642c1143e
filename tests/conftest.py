import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", "stationflow-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def folder(tmp_path):
    """A fresh folder for one test's files (file: URI for Spark)."""
    return "file://" + str(tmp_path)
