import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskfeat.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture()
def hot_keys_everywhere(spark):
    """Treat keys with more than 20 rows as hot."""
    spark.conf.set("spark.riskfeat.hotRows", "20")
    yield
    spark.conf.unset("spark.riskfeat.hotRows")
