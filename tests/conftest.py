import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stateline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        partitions=4,
        **{
            "spark.checkpoint.dir": str(base / "scratch"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""

    def read(df, *names):
        found = df.select(*names) if names else df
        return sorted((tuple(r) for r in found.collect()), key=lambda r: tuple((v is None, v) for v in r))

    return read
