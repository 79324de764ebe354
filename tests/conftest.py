import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from series_lake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture
def landed(tmp_path):
    """Writes lines as one raw file and returns its folder."""

    def write(*lines, name="raw"):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
        return str(folder)

    return write
