import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recprep.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "recprep-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def uncoalesced(spark):
    """Small tables stay in as many partitions as large ones would have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def make_events(spark):
    """Unified events from partial rows; an ``event_id`` numbers them."""
    from recprep.sources.events import EVENT_COLUMNS

    def build(rows):
        ddl = ", ".join(f"{n} {t}" for n, t in EVENT_COLUMNS.items()) + ", event_id long"
        full = []
        for i, row in enumerate(rows):
            known = {"discount_flag": False, **row}
            full.append(tuple(known.get(c) for c in EVENT_COLUMNS) + (i,))
        return spark.createDataFrame(full, ddl)

    return build
