import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnstile.schema import GATE_EVENT  # noqa: E402
from turnstile.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        app_name="turnstile-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests own no cluster: give a checkpoint folder only where the session has none.
    if s.conf.get("spark.checkpoint.dir", None) is None:
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def events(spark):
    """Build a gate-event frame from tuples (event_id, student, type, gate, location, time)."""

    def make(rows):
        data = [(*r[:5], ts(r[5]) if isinstance(r[5], str) else r[5]) for r in rows]
        return spark.createDataFrame(data, GATE_EVENT)

    return make


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
