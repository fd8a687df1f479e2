import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from godown.session import get_session
    s = get_session("local[4]", 8, driver_memory="6g")
    yield s


@pytest.fixture(scope="session")
def build(spark):
    from godown.plans.registry import build_for
    return build_for(spark, SF)
