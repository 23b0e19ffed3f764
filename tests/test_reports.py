import datetime as dt

import pytest
from conftest import SMALL

from lapstar.plans import reports
from lapstar.schemas import (
    DIM_COMPETITION, DIM_EVENT, DIM_SWIMMER, FACT_PERFORMANCE, FACT_RANKINGS, Params, Warehouse,
)
from lapstar.operators import facts
from workload.staging import AS_OF, GATES, warehouse

BORN = dt.date(2003, 6, 30)


def rows(df):
    return [tuple(r) for r in df.collect()]


def swimmer(sk, name, nationality="USA", current=True, born=BORN):
    return (sk, f"SWM{sk}", name, born, "F", nationality, current, BORN, None, 1, None, None)


@pytest.fixture()
def build(spark):
    """A warehouse from swimmers and swims (swimmer_sk, event_sk, competition_sk, time, rank)."""

    def make(swimmers, swims, competitions=9):
        events = [(1, 50, "Freestyle", "LCM"), (2, 100, "Freestyle", "LCM"), (3, 50, "Backstroke", "LCM")]
        meets = [(i, f"M{i}", dt.date(2018, 1, i), "AUS", "Local") for i in range(1, competitions + 1)]
        facts_rows = [(i, *s, 18) for i, s in enumerate(swims, 1)]
        performance = spark.createDataFrame(facts_rows, FACT_PERFORMANCE)
        return Warehouse(
            spark.createDataFrame(swimmers, DIM_SWIMMER),
            spark.createDataFrame(events, DIM_EVENT),
            spark.createDataFrame(meets, DIM_COMPETITION),
            performance,
            facts.rankings(performance).select(*FACT_RANKINGS.names),
        )

    return make


def test_own_ranks_with_ties_and_missing_times(build):
    swims = [(1, 1, 1, 25.0, 1), (1, 1, 2, None, 9), (1, 2, 3, 25.0, 1), (1, 1, 4, 26.0, 1), (1, 1, 5, None, 9)]
    wh = build([swimmer(1, "A")], swims)
    # 25.0 twice is rank 1 twice, 26.0 rank 3, the two missing times rank 4.
    assert rows(reports.swimmer_rankings(wh)) == [("A", "Freestyle", 2, 0, 1, 2, 0)]


def test_many_equal_times_take_one_rank(build):
    wh = build([swimmer(1, "A"), swimmer(2, "A")], [(1, 1, 1, 30.0, 1)] * 20 + [(1, 1, 2, 31.0, 1), (2, 1, 1, 9.0, 1)])
    assert rows(reports.swimmer_rankings(wh)) == [("A", "Freestyle", 21, 0, 0, 0, 0)]


def test_club_counts(build):
    swimmers = [swimmer(1, "A"), swimmer(2, "B", current=False), swimmer(3, "C", "AUS"), swimmer(4, "D", "CAN")]
    wh = build(swimmers, [(1, 1, 1, 25.0, 1), (1, 2, 1, 55.0, 1), (2, 1, 1, 26.0, 2), (3, 3, 1, 30.0, 1)])
    note = "Club data not available"
    assert rows(reports.club_region_performance(wh)) == [("AUS", note, 0, 0, 1, 0), ("USA", note, 0, 2, 0, 0)]
    assert rows(reports.swimmer_demographics(wh))[0] == ("USA", 2, 1, "USA")


def test_cuts(build):
    swimmers = [swimmer(1, "A"), swimmer(2, "A", current=False), swimmer(3, "B"), swimmer(4, "C")]
    swims = [(1, 1, 1, 26.0, 1), (1, 2, 1, 25.0, 1), (2, 1, 1, 20.0, 1), (3, 1, 1, 30.0, 1), (4, 3, 1, None, None)]
    wh = build(swimmers, swims)
    assert rows(reports.olympic_cuts(wh)) == [
        ("C", "USA", "Backstroke", None, "Not Qualified"),
        ("A", "USA", "Freestyle", 25.0, "A Cut"),
        ("B", "USA", "Freestyle", 30.0, "B Cut"),
    ]


def test_last_five_count_swims_by_date(build):
    early = [(1, 1, 1, 25.0, 1), (1, 1, 2, 25.0, 1)]
    late = [(1, 1, 3, 25.0, 1), (1, 2, 4, 25.0, 1), (1, 1, 5, 25.0, 2), (1, 1, 6, 25.0, 1), (1, 1, 7, 25.0, 2)]
    wh = build([swimmer(1, "A")], early + late)
    assert rows(reports.last_five_rankings(wh)) == [("A", "USA", "Freestyle", 3)]
    assert rows(reports.last_five_rankings(wh, Params(min_wins=4))) == []


def test_qualifications_count_competitions_once(build):
    swims = [
        (1, 1, 1, 25.0, 1), (1, 2, 1, 21.0, 9), (1, 1, 2, 50.0, 6), (1, 1, 3, 50.01, 5), (1, 1, 4, None, None),
        (2, 1, 1, 25.0, 1), (3, 1, 1, 25.0, 1), (1, 1, 99, 25.0, 1),
    ]
    swimmers = [swimmer(1, "A"), swimmer(2, "B", born=dt.date(2010, 1, 1)), swimmer(3, "C", current=False)]
    gates = Params(min_competitions=1, min_qualifying=1)
    found = rows(reports.olympic_qualifications(build(swimmers, swims), "2018-06-29", gates))
    # Competition 99 is unknown; 1 and 2 are in time; 1 and 3 are in the first five places.
    assert found == [("A", "USA", 14, "12-14", "Freestyle", 4, 2, 2)]
    after = rows(reports.olympic_qualifications(build(swimmers, swims), "2018-06-30", gates))
    assert after[0][2:4] == (15, "15-17")
    assert rows(reports.olympic_qualifications(build(swimmers, swims), "2018-06-30")) == []


def test_qualified_swimmers_with_one_name(build):
    """Namesakes of two nations: the report joins by name, so each gets the cuts and wins of both."""
    swimmers = [swimmer(1, "A"), swimmer(2, "A", "CHN")]
    swims = [(1, 1, 1, 24.0, 1), (1, 1, 2, 24.0, 1), (2, 1, 1, 29.0, 1), (2, 1, 2, 29.0, 2)]
    gates = Params(min_competitions=2, min_qualifying=2, min_wins=1)
    found = rows(reports.olympic_qualified_swimmers(build(swimmers, swims), AS_OF, gates))
    assert len(found) == 8
    assert {f[1] for f in found} == {"USA", "CHN"}
    assert [f[5] for f in found] == ["A Cut"] * 4 + ["B Cut"] * 4
    assert [f[6] for f in found] == [2, 2, 1, 1] * 2
    assert rows(reports.qualified_summary(build(swimmers, swims), AS_OF, gates)) == [
        ("A Cut", "Freestyle", 4), ("B Cut", "Freestyle", 4)]


def test_default_gates_leave_nobody(spark):
    assert rows(reports.olympic_qualified_swimmers(warehouse(spark, SMALL), AS_OF)) == []


def test_order_of_the_flagship(spark):
    found = rows(reports.olympic_qualified_swimmers(warehouse(spark, SMALL), AS_OF, GATES))
    assert len(found) == 219
    assert found == sorted(found, key=lambda r: (r[5], r[4], -r[6], r[0]))


def test_reports_by_name(spark):
    reports.register_views(spark, warehouse(spark, SMALL), AS_OF, GATES)
    found = rows(
        spark.sql(
            """SELECT olympic_cut, stroke, COUNT(*) AS qualified_count FROM vw_olympic_qualified_swimmers
            GROUP BY olympic_cut, stroke ORDER BY olympic_cut, stroke"""
        )
    )
    assert len(found) == 10
    assert found == rows(reports.qualified_summary(warehouse(spark, SMALL), AS_OF, GATES))
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert {"vw_swimmer_rankings", "vw_club_region_performance", "vw_swimmer_demographics", "vw_olympic_cuts",
            "vw_last_five_rankings", "vw_olympic_qualifications", "vw_olympic_qualified_swimmers"} <= views
