import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from civiclens.plans.workspace import Workspace, workspace  # noqa: E402
from civiclens.schema import RAW_SCHEMA  # noqa: E402
from civiclens.session import local_session  # noqa: E402

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "civiclens-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ws(spark, folder):
    return workspace(spark, folder)


@pytest.fixture
def raw_frame(spark):
    """Raw requests from dicts; absent columns are NULL."""

    def build(*records):
        rows = [tuple(r.get(name) for name in RAW_SCHEMA.names) for r in records]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


@pytest.fixture
def space(spark):
    """A workspace over a given raw frame."""
    return lambda frame: Workspace(spark, frame)


@pytest.fixture
def stage(spark):
    return Workspace(spark, lambda: spark.range(0)).stage
