from __future__ import annotations

import pytest

from tests.session import test_session


@pytest.fixture(scope="session")
def spark():
    return test_session()


@pytest.fixture
def lake(spark, tmp_path):
    from tidemark.sources.lake import Lake

    return Lake(spark, str(tmp_path / "lake"))
