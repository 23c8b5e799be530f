import os
import sys
import tempfile

import pytest
from hypothesis import settings

# property tests draw the same examples on every run (no flaky rounds)
settings.register_profile("repeatable", derandomize=True, database=None)
settings.load_profile("repeatable")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from valuora.session import get_spark
    s = get_spark("local[8]", app="valuora-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="valuora-test-")
