import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from faresight.session import ensure_checkpoint_dir, get_session, release_tables
    s = get_session("local[4]", app="faresight-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    ensure_checkpoint_dir(s)
    yield s
    release_tables(s)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
