import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402

RUN_TS = dt.datetime(2024, 1, 31, 8, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tidemark-tests",
        "4",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{shared}"},
    )
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return RUN_TS


def rows(df, *order):
    """All rows as dicts, in order of the named columns."""
    data = [r.asDict() for r in df.collect()]
    return sorted(data, key=lambda r: tuple(str(r[c]) for c in order)) if order else data
