import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4, app="ledgerline-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from ledgerline.session import shared_dir
    return shared_dir(spark, "test")


def rows(df, *order):
    """Collect a small result as a list of dicts, sorted."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in (order or sorted(r))))
