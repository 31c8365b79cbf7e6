from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mart_samples import edge_rows, make_oltp  # noqa: E402
from salesmart.plans.model import Oltp  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import get_spark

    s = get_spark("local[4]", 8, app_name="salesmart-tests",
                  extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="salesmart-test-", dir="/tmp")


@pytest.fixture(scope="session")
def edge_oltp(spark) -> Oltp:
    return make_oltp(spark, **edge_rows())


@pytest.fixture(scope="session")
def edge_mart(edge_oltp):
    from salesmart.plans.mart import build_mart

    return build_mart(edge_oltp)
