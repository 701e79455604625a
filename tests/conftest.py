import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tablefit.session import get_session, shared_dir

    s = get_session("local[*]", 8)
    shared_dir(s)  # sets a checkpoint folder only when the session has none
    yield s


@pytest.fixture(scope="session")
def reg(spark):
    from tablefit.sources import tables

    return tables.lineitem_regression(spark, SF_SMALL).cache()
