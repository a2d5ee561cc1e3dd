import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tidemark-tests", "local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(repr, r)))


@pytest.fixture()
def write_lines(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write
