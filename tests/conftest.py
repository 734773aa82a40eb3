import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from care_analytics.session import local_session
    session = local_session(cores="*", shuffle_partitions=8, app="care-analytics-tests")
    # plan tests look for table names in the locations of scans
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("CARE_TEST_SF", "/root/testdata/sf0.001")
