from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from dealspark.session import local_session  # noqa: E402
from dealspark.sources.layers import Layout  # noqa: E402
from dealspark.sources.readers import read_bronze  # noqa: E402
import crm_data  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, app="dealspark-tests")


@pytest.fixture(scope="session")
def sample_root(tmp_path_factory) -> str:
    return crm_data.write_bronze(str(tmp_path_factory.mktemp("crm")))


@pytest.fixture(scope="session")
def raw(spark, sample_root):
    layout = Layout(sample_root)
    return {e: read_bronze(spark, layout.bronze(e), e)
            for e in ("leads", "customers", "interactions", "products")}


@pytest.fixture(scope="session")
def clean(raw):
    from dealspark.operators.clean import CLEANERS
    return {e: CLEANERS[e](df).cache() for e, df in raw.items()}
