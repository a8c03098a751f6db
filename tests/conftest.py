import os
import sys
from pathlib import Path

# eight tasks multiply small matrices side by side: one thread each
for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    os.environ.setdefault(name, "1")

import pytest  # noqa: E402

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", shuffle_partitions=4)
    yield session
    session.stop()
