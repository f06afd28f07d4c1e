import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courierlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="courierlake-test-ckpt-")
    s = build_session("local[4]", app="courierlake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def explain(df, mode="formatted"):
    """The plan text ``df.explain(mode)`` would print."""
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
