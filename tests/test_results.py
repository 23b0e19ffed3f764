import random
import re

import pytest
from conftest import SMALL, swim
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.operators import results
from lapstar.sources.files import read_summary, write_summary
from workload.staging import SRC, raw_results

EVENTS = ["50m Freestyle", "100m Freestyle", "50m Butterfly"]


def seconds(text):
    return None if text in (None, "DNS") else float(text)


def make(swims, hot):
    """Swims of five swimmers at ten meets; swimmer 0 has the share ``hot`` of them."""
    rng = random.Random(3)
    rows = []
    for i in range(swims):
        meet = rng.randrange(10)
        time = rng.choice([None, "DNS"]) if rng.random() < 0.1 else f"{rng.uniform(20, 59):.2f}"
        swimmer = 0 if rng.random() < hot else rng.randrange(5)
        # Sponsor carries the row number: it breaks ties and names the row.
        rows.append(swim(swimmer, rng.choice(EVENTS), time, f"M{meet}", f"2018-01-{meet + 1:02}", Sponsor=f"{i:05}"))
    return rows


@pytest.fixture(scope="module")
def swims():
    return make(500, 0.5)


@pytest.fixture()
def raw(raw_frame, swims):
    return raw_frame(swims).repartition(5)


TIE = ["Sponsor"]


def careers(swims):
    found = {}
    for row in sorted(swims, key=lambda r: (r["Competition_Date"], r["Competition_Competition_Id"], r["Sponsor"])):
        found.setdefault((row["SwimmerId"], row["Event"]), []).append(row)
    return found


def finishes(swims):
    fields = {}
    for row in swims:
        fields.setdefault((row["Competition_Competition_Id"], row["Event"]), []).append(row)

    def fastest(row):
        time = seconds(row["Time"])
        return (time is None, time or 0, row["SwimmerId"], row["Sponsor"])

    return {
        r["Sponsor"]: i if seconds(r["Time"]) is not None else None
        for field in fields.values() for i, r in enumerate(sorted(field, key=fastest), 1)
    }


def test_places(raw, swims):
    placed = results.places(raw, TIE).collect()
    assert {r.Sponsor: r.place for r in placed} == finishes(swims)
    assert all(r.Top_5 == ("Yes" if r.place and r.place <= 5 else "No") for r in placed)


def test_top5_and_counts(raw, swims):
    places = finishes(swims)
    top = results.top5(raw, TIE).collect()
    assert {r.Sponsor: r.place for r in top} == {k: p for k, p in places.items() if p and p <= 5}
    expected = {}
    for row in swims:
        place = places[row["Sponsor"]]
        if place and place <= 5:
            key = (row["SwimmerId"], row["Event"].split("m ")[1])
            expected.setdefault(key, [0] * 5)[place - 1] += 1
    found = results.place_counts(raw, TIE).collect()
    assert {(r.swimmer_id, r.stroke): list(r)[2:] for r in found} == expected


def test_personal_bests(raw, swims):
    expected = {}
    for career in careers(swims).values():
        best = None
        for row in career:
            time = seconds(row["Time"])
            best = time if best is None else best if time is None else min(best, time)
            expected[row["Sponsor"]] = (best, time is not None and time == best)
    found = results.personal_bests(raw, TIE).collect()
    assert {r.Sponsor: (r.best_so_far, r.is_personal_best) for r in found} == expected


def test_rolling_history_keeps_fifty(raw, swims):
    expected = {}
    for career in careers(swims).values():
        times = []
        for row in career:
            times += [] if seconds(row["Time"]) is None else [seconds(row["Time"])]
            expected[row["Sponsor"]] = times[-50:]
    assert max(map(len, expected.values())) == 50
    found = results.rolling_history(raw, tie=TIE).collect()
    assert {r.Sponsor: r.history for r in found} == expected


def test_completed_results(raw, swims):
    done = {r.Sponsor: r for r in results.as_results(raw, TIE).collect()}
    places = finishes(swims)
    assert len(done) == len(swims)
    for row in swims:
        found = done[row["Sponsor"]]
        place = places[row["Sponsor"]]
        assert found.Overall_Rank == (None if place is None else str(place))
        assert found.Competition_Date == row["Competition_Date"] and found.Time == row["Time"]
        if seconds(row["Time"]) is not None:
            assert found.Historical_Times.endswith(f"'{row['Time']}']")
    assert {r.Is_Personal_Best for r in done.values()} == {"True", "False"}
    assert {r.Is_Valid_Record for r in done.values()} == {"True"}


def test_eligibility(raw_frame):
    def entry(number, **more):
        base = {"Is_Disqualified": "False", "Residency_Years": "5", "Vaccination_Status": "Fully Vaccinated"}
        return swim(number, "50m Freestyle", "25.00", "M1", "2018-01-01", **{**base, **more})

    rows = [
        entry(1),
        entry(2, Is_Disqualified="True"),
        entry(3, Birth_Country="CHN", Residency_Years="1"),
        entry(4, Birth_Country="CHN", Residency_Years="2"),
        entry(5, Vaccination_Status="Exemption"),
        entry(6, Vaccination_Status="Exemption", Competition_Level="National"),
        entry(7, Residency_Years="0"),
        entry(8, Birth_Country="CHN", Residency_Years=None),
    ]
    found = results.eligible(raw_frame(rows)).collect()
    assert sorted(r.SwimmerId for r in found) == ["SWM1", "SWM4", "SWM5", "SWM7"]


def test_entry_caps_follow_the_level(raw_frame):
    rows = [
        swim(f"{i:03}", "50m Freestyle", "25.00", str(level), "2018-01-01", Competition_Level=level)
        for level in ("National", "Province", "Local", "Unknown", None)
        for i in range(70)
    ]
    entries = results.top_entries(raw_frame(rows)).collect()
    counts = {}
    for r in entries:
        counts[r.Competition_Level] = counts.get(r.Competition_Level, 0) + 1
        assert r.entry_no == int(r.SwimmerId[3:]) + 1
    assert counts == {"National": 60, "Province": 45, "Local": 35, "Unknown": 70, None: 70}


def test_summary(raw_frame, swims, spark, tmp_path):
    # The same swims with one sponsor each, and an age that grows: the newest attributes are listed.
    same = [{**r, "Sponsor": "None", "Age": str(18 + int(r["Competition_Date"][-2:]))} for r in swims]
    five = results.rankings_summary(raw_frame(same))
    assert len(five.columns) == 23
    found = {(r.id, r.Stroke): r for r in five.collect()}
    assert five.count() == len(found) == 25
    assert found["SWM0", "Freestyle"].age == "28"
    lengths = {}
    for (swimmer, event), career in careers(swims).items():
        times = sum(seconds(r["Time"]) is not None for r in career)
        lengths[swimmer, event.split("m ")[1], int(event.split("m ")[0])] = min(times, 50)
    for (swimmer, stroke), row in found.items():
        for metres, times in row.Historical_Records.items():
            assert len(times) == lengths.get((swimmer, stroke, metres), 0)
    assert set(found["SWM0", "Freestyle"].Historical_Records) == {50, 100, 200, 400, 800, 1500}
    assert found["SWM0", "Backstroke"].Rank1_Count == 0
    write_summary(five, str(tmp_path / "summary"))
    back = read_summary(spark, str(tmp_path / "summary"))
    assert sorted(back.collect(), key=str) == sorted(five.collect(), key=str)


def test_summary_keeps_the_newest_times_oldest_first(raw_frame):
    rows = [swim(1, "50m Freestyle", f"{30 + i}.00", f"M{i:02}", f"2018-01-{i + 1:02}") for i in range(9)]
    found = results.rankings_summary(raw_frame(rows), length=4).filter("Stroke = 'Freestyle'").first()
    assert found.Historical_Records[50] == [35.0, 36.0, 37.0, 38.0]
    assert found.Rank1_Count == 9


def test_properties_of_the_staged_results(spark):
    raw = raw_results(spark, SMALL)
    placed = results.places(raw, SRC)
    spans = placed.groupBy(*results.COMPETITION_EVENT).agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.count_distinct("place").alias("n"),
        F.count("time_seconds").alias("rows"),
    )
    assert placed.filter("place IS NULL AND time_seconds IS NOT NULL OR place IS NOT NULL AND time_seconds IS NULL").isEmpty()
    assert spans.filter("low <> 1 OR high <> rows OR n <> rows").isEmpty()
    best = results.personal_bests(raw, SRC)
    career = Window.partitionBy(*results.CAREER_KEYS).orderBy("swim_date", "Competition_Competition_Id", *SRC)
    before = F.lag("best_so_far").over(career)
    assert best.withColumn("before", before).filter("best_so_far > before").isEmpty()
    assert best.filter("is_personal_best AND time_seconds > best_so_far").isEmpty()


def test_summary_sorts_no_raw_rows_for_the_newest_attributes(raw):
    plan = results.rankings_summary(raw, tie=TIE)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[SwimmerId[^\]]*Education_Level[^\]]*\], functions=\[partial_max", plan)


def test_newest_attributes_of_the_summary(raw_frame):
    rows = [
        swim(1, EVENTS[0], "20.00", "M1", "2018-01-01", Name="old"),
        swim(1, EVENTS[0], "20.00", "M2", "2018-02-01", Name="new", Club=None),
        swim(1, EVENTS[0], "20.00", "M3", "2018-02-01", Name="new", Club="A"),
        swim(1, EVENTS[0], "20.00", "M4", None, Name="undated"),
        swim(2, EVENTS[0], "20.00", "M4", None, Name="a"),
        swim(2, EVENTS[0], "20.00", "M4", None, Name="b"),
    ]
    found = results.rankings_summary(raw_frame(rows), tie=["Name"]).select("id", "name", "club").distinct().collect()
    assert sorted(map(tuple, found)) == [("SWM1", "new", "A"), ("SWM2", "b", None)]
