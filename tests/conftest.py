import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voronoi.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="voronoi-tests")
    yield s


def pts(spark, rows, with_id=False):
    if with_id:
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id bigint, dims array<double>")
    return spark.createDataFrame([([float(x) for x in v],) for v in rows], "dims array<double>")


def cents(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "cluster_id bigint, dims array<double>")
