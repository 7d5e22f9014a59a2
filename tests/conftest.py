import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weirflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A folder of its own: tables of an earlier run that was stopped are in nobody's way.
    session = local_session(4, "weirflow-tests", tempfile.mkdtemp(prefix="weirflow-warehouse-"))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A DataFrame with one ``value`` column of the given texts."""

    def make(*values):
        rows = [(i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "seq bigint, value string").coalesce(1)

    return make
