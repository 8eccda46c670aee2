import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from parcelkit.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def zones(spark):
    """The literal hard-case shapes of fx_zone_ring as vertex rows."""
    from parcelkit.sources.fixtures import VIEWS
    return spark.sql(VIEWS["fx_zone_ring"])
