import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamfold.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="sf-test-ckpt-")
    s = get_session("local[4]", app="streamfold-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted list of dicts."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    key = order or (lambda d: tuple((v is None, str(v)) for v in d.values()))
    return sorted(out, key=key)
