import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark("local[4]", app="tessera-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of dicts (selected columns, in row order)."""
    cols = cols or df.columns
    return [{c: r[c] for c in cols} for r in df.select(*cols).collect()]
