import datetime as dt

import pytest

from lapstar.operators import scd2

DAY = dt.date(2018, 6, 30)
FIRST = dt.date(2000, 1, 1)
COLUMNS = "k string, name string, nat string, is_current boolean, valid_from date, valid_to date, version int"


def version(key, name, nat, current=True, start=FIRST, end=None, number=1):
    return (key, name, nat, current, start, end, number)


EXISTING = [
    version("same", "A", "USA"),
    version("same null", "A", None),
    version("changed", "A", "USA"),
    version("to null", "A", "USA"),
    version("from null", "A", None),
    version("absent", "A", "USA"),
    version("third", "A", "USA", False, FIRST, dt.date(2010, 1, 1), 1),
    version("third", "B", "USA", True, dt.date(2010, 1, 1), None, 2),
]
FEED = [
    ("same", "A", "USA"),
    ("same null", "A", None),
    ("changed", "B", "USA"),
    ("to null", "A", None),
    ("from null", "A", "USA"),
    ("third", "C", "USA"),
    ("new", "N", "CAN"),
]


@pytest.fixture()
def frames(spark):
    return spark.createDataFrame(EXISTING, COLUMNS), spark.createDataFrame(FEED, "k string, name string, nat string")


def test_changes(frames):
    found = {r.k: r.change for r in scd2.classify(*frames, "k", ["name", "nat"]).collect()}
    assert found == {
        "same": "same", "same null": "same", "changed": "changed", "to null": "changed", "from null": "changed",
        "third": "changed", "new": "new", "absent": "absent",
    }


def expected():
    closed = {"changed", "to null", "from null"}
    rows = []
    for row in EXISTING:
        if row[0] in closed or (row[0] == "third" and row[3]):
            row = (*row[:3], False, row[4], DAY, row[6])
        rows.append(row)
    numbers = {"changed": 2, "to null": 2, "from null": 2, "third": 3, "new": 1}
    rows += [version(k, n, c, True, DAY, None, numbers[k]) for k, n, c in FEED if k in numbers]
    return sorted(rows, key=str)


def test_snapshot(frames):
    merged = scd2.merge(*frames, "k", ["name", "nat"], DAY)
    assert sorted(map(tuple, merged.collect()), key=str) == expected()


def test_merging_again_changes_nothing(spark, frames):
    once = scd2.merge(*frames, "k", ["name", "nat"], DAY).collect()
    twice = scd2.merge(spark.createDataFrame(once, COLUMNS), frames[1], "k", ["name", "nat"], "2019-01-01")
    assert sorted(map(tuple, twice.collect()), key=str) == expected()


def test_ids_that_occur_twice_do_not_multiply(spark):
    existing = spark.createDataFrame([version("x", "A", "USA"), version("x", "B", "USA")], COLUMNS)
    rows = [("x", "B", "USA"), ("x", "C", "USA"), ("x", "C", "USA")]
    feed = spark.createDataFrame(rows, "k string, name string, nat string")
    merged = scd2.merge(existing, feed, "k", ["name", "nat"], DAY)
    found = sorted((r.name, r.is_current, r.version) for r in merged.collect())
    assert found == [("A", False, 1), ("B", True, 1), ("C", True, 2)]


def test_null_keys_match(spark):
    existing = spark.createDataFrame([version(None, "A", "USA")], COLUMNS)
    feed = spark.createDataFrame([(None, "A", "USA")], "k string, name string, nat string")
    assert scd2.merge(existing, feed, "k", ["name", "nat"], DAY).count() == 1
