import logging
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from lapstar.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, values):
    """Session settings for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    logging.getLogger("lapstar").setLevel(logging.ERROR)
    session = local_session(
        8, "4g", **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    yield session
    session.stop()


@pytest.fixture()
def raw_row():
    """A raw results row from a few values; the rest is null."""
    from lapstar.schemas import RAW_COLUMNS

    def build(**values):
        return tuple(values.get(name) for name in RAW_COLUMNS)

    return build


@pytest.fixture()
def raw_frame(spark, raw_row):
    from lapstar.schemas import RAW

    def build(rows):
        return spark.createDataFrame([raw_row(**row) for row in rows], RAW)

    return build


def swim(swimmer, event, time, competition, date, **more):
    """One raw results row of a swimmer ``SWM<n>``."""
    return {
        "SwimmerId": f"SWM{swimmer}",
        "Name": f"Name {swimmer}",
        "Birth_Date": "2000-02-29",
        "Age": "18",
        "Gender": "Women",
        "Citizenship": "USA",
        "Birth_Country": "USA",
        "Event": event,
        "Time": time,
        "Overall_Rank": "1",
        "Competition_Date": date,
        "Competition_Level": "Local",
        "Competition_Competition_Id": competition,
        "Competition_Country": "AUS",
        **more,
    }
