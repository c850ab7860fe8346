import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from periodica.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        8,
        **{
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            # plans are compared as text
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(shared / "checkpoints"),
        },
    )
    yield session
    session.stop()
