from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from starweave.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="starweave-tests")
    yield s
    s.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))
