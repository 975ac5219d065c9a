import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from registra.session import build_session

    session = build_session("local[4]", app="tests", shuffle_partitions=4, spark__driver__memory="4g")
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def rows():
    """A frame's rows as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
