import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vitrine.session import build_session, clear_scratch
    s = build_session("local[8]", shuffle_partitions=8, app_name="vitrine-tests")
    yield s
    clear_scratch(s)


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
