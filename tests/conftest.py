import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import get_session
    s = get_session("local[4]", app_name="quayside-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="qs-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def zone(tmp_path):
    """A raw zone: returns (root, write) where write(name, text) puts a file
    at <root>/raw/<name>."""
    root = tmp_path / "zone"
    (root / "raw").mkdir(parents=True)

    def write(name, text, encoding="utf-8"):
        p = root / "raw" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(text.encode(encoding))
        return str(p)

    return str(root), write
