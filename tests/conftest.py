import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import get_session
    s = get_session("local[4]", 8)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from touchline.session import scratch_path
    return scratch_path(spark, "test")


def write_docs(folder: str, docs: dict[str, str]) -> None:
    """Land raw JSON text files (one document per file, like the extract)."""
    os.makedirs(folder.replace("file:", ""), exist_ok=True)
    for name, text in docs.items():
        with open(os.path.join(folder.replace("file:", ""), name), "w") as f:
            f.write(text)
