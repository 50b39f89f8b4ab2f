import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from lociflow.scale import local_session

    session = local_session("8", app="tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as sorted tuples, missing values first."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda t: tuple((x is not None, x if not isinstance(x, (list, dict)) else str(x)) for x in t))
