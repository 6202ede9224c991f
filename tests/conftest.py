import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from civitally.workspace import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def ntz_rows(spark):
    """DataFrame from rows whose date columns are ISO text in the given schema."""

    def make(rows, schema: str, *dates: str):
        df = spark.createDataFrame(rows, schema)
        return df.withColumns({c: df[c].cast("timestamp_ntz") for c in dates})

    return make
