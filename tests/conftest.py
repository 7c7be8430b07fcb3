import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from textloom import runtime

    spark = runtime.session("8", 8)
    yield spark
    spark.stop()
