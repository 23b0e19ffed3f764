import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from conftest import SMALL, swim
from pyspark.sql import functions as F

from lapstar.operators import dims, facts, keys, quality
from lapstar.plans import load
from lapstar.plans.load import load_files, read_warehouse, reset, row_counts, run_load
from lapstar.schemas import RAW_COLUMNS, SOURCE, TEXT_LIMITS, USED_COLUMNS
from lapstar.session import shared_folder
from lapstar.sources.files import write_results
from workload import queries
from workload.staging import AS_OF, SRC, new_database, raw_results, warehouse


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


FIRST = [
    swim(1, "50m Freestyle", "25.00", "M1", "2018-01-01"),
    swim(2, "50m Freestyle", "26.00", "M1", "2018-01-01", Overall_Rank="2"),
    swim(1, "100m Freestyle", "55.00", "M1", "2018-01-01"),
]
SECOND = [
    swim(1, "50m Freestyle", "24.00", "M2", "2018-02-01", Overall_Rank="3"),
    swim(2, "50m Freestyle", "27.00", "M2", "2018-02-01", Citizenship="CHN"),
    swim(3, "200m Butterfly", "2:05.00", "M2", "2018-02-01"),
    swim(1, "Relay", "24.00", "M2", "2018-02-01"),
]


def test_second_load_keeps_keys_and_history(spark, raw_frame):
    name = new_database(spark)
    first = run_load(spark, raw_frame(FIRST), name, "first", "2018-01-02")
    keys = dict(values(first.swimmers, "swimmer_id", "swimmer_sk"))
    events = dict(values(first.events.selectExpr("concat(distance, stroke) AS e", "event_sk"), "e", "event_sk"))
    loaded = run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")

    history = values(loaded.swimmers, "swimmer_id", "nationality", "is_current", "version", "swimmer_sk", "valid_to")
    assert history == [
        ("SWM1", "USA", True, 1, keys["SWM1"], None),
        ("SWM2", "CHN", True, 2, history[1][4], None),
        ("SWM2", "USA", False, 1, keys["SWM2"], dt.date(2018, 2, 2)),
        ("SWM3", "USA", True, 1, history[3][4], None),
    ]
    assert {history[1][4], history[3][4]} == {3, 4}
    found = dict(values(loaded.events.selectExpr("concat(distance, stroke) AS e", "event_sk"), "e", "event_sk"))
    assert events.items() <= found.items() and set(found.values()) == {1, 2, 3, 4}
    assert values(loaded.competitions, "competition_id", "competition_sk") == [("M1", 1), ("M2", 2)]

    # The relay has no distance, so no event matches it; the swim of the changed swimmer has the new version.
    swims = values(loaded.performance, "performance_id", "swimmer_sk", "time_seconds")
    assert [s[0] for s in swims] == [1, 2, 3, 4, 5, 6]
    assert (history[1][4], 27.0) in [s[1:] for s in swims]
    best = values(loaded.rankings.filter(f"swimmer_sk = {keys['SWM1']}"), "event_sk", "best_time", "best_rank")
    assert best == [(events["50Freestyle"], 24.0, 1), (events["100Freestyle"], 55.0, 1)]
    assert quality.duplicates(loaded.rankings, ["swimmer_sk", "event_sk"]).isEmpty()

    def everything():
        now = read_warehouse(spark, name)
        frames = [now.swimmers, now.events, now.competitions, now.performance, now.rankings]
        return [values(f, *f.columns) for f in frames]

    before = everything()
    run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")
    assert everything() == before

    reset(spark, name)
    assert row_counts(read_warehouse(spark, name)).agg({"rows": "sum"}).first()[0] == 0


def test_replacing_a_load_leaves_only_its_own_minima(spark, raw_frame):
    def one(time, rank="1", number=1):
        return raw_frame([swim(number, "50m Freestyle", time, "M1", "2018-01-01", Overall_Rank=rank)])

    name = new_database(spark)
    first = run_load(spark, one("25.00"), name, "a", "2018-01-02")
    pair = values(first.rankings, "ranking_id")
    run_load(spark, one("26.00", "2"), name, "b", "2018-01-02")
    slower = run_load(spark, one("28.00", "4"), name, "a", "2018-01-02")
    assert values(slower.rankings, "best_time", "best_rank") == [(26.0, 2)]
    other = run_load(spark, one("20.00", number=2), name, "a", "2018-01-02")
    assert values(other.rankings, "best_time") == [(20.0,), (26.0,)]
    back = run_load(spark, one("25.00"), name, "a", "2018-01-02")
    assert values(back.rankings, "ranking_id", "best_time") == [(*pair[0], 25.0)]


def test_an_older_load_comes_again(spark, raw_frame):
    def named(text, time):
        return raw_frame([swim(1, "50m Freestyle", time, "M1", "2018-01-01", Name=text)])

    name = new_database(spark)
    run_load(spark, named("Ann", "25.00"), name, "a", "2018-01-02")
    before = run_load(spark, named("Ann Lee", "26.00"), name, "b", "2018-01-03")
    before = [values(f, *f.columns) for f in (before.swimmers, before.performance, before.rankings)]
    after = run_load(spark, named("Ann", "25.00"), name, "a", "2018-01-04")
    assert values(after.swimmers, "name", "version", "is_current") == [("Ann Lee", 2, True), ("Ann", 1, False)]
    assert values(after.swimmers, *after.swimmers.columns) == before[0]
    assert [values(f, *f.columns) for f in (after.performance, after.rankings)] == before[1:]
    # More swims than the load had before get a range of their own.
    more = raw_frame([swim(1, "50m Freestyle", f"3{i}.00", "M1", "2018-01-01", Name="Ann") for i in range(3)])
    grown = run_load(spark, more, name, "a", "2018-01-04")
    assert values(grown.performance, "performance_id") == [(2,), (3,), (4,), (5,)]


@pytest.mark.parametrize("shared", [False, True])
def test_an_older_load_is_matched_by_attributes_where_ids_are_shared_only(spark, raw_frame, monkeypatch, shared):
    twin = [swim(1, "50m Freestyle", "31.00", "M1", "2018-01-01", Name="Twin")] if shared else []
    first, second = raw_frame(FIRST + twin), raw_frame([{**row, "Name": "Renamed"} for row in FIRST[:1]])
    database, used, number = new_database(spark), [], facts.numbered_swims
    monkeypatch.setattr(facts, "numbered_swims", lambda raw, tie, attributes: used.append(attributes) or number(raw, tie, attributes))
    before = run_load(spark, first, database, "first", "2018-01-02").performance.collect()
    run_load(spark, second, database, "second", "2018-01-03")
    after = run_load(spark, first, database, "first", "2018-01-04").performance.filter("performance_id <= " + str(len(before)))
    assert used == [shared, False, shared]
    assert sorted(map(str, after.collect())) == sorted(map(str, before))


def test_two_loads_at_once_follow_each_other(spark, raw_frame):
    name = new_database(spark)
    frames = {"first": raw_frame(FIRST), "second": raw_frame(SECOND)}
    with ThreadPoolExecutor(2) as pool:
        done = [pool.submit(run_load, spark, raw, name, load_id, "2018-03-01") for load_id, raw in frames.items()]
        for each in done:
            each.result()
    loaded = read_warehouse(spark, name)
    assert loaded.performance.count() == 6
    for key, frame in {"performance_id": loaded.performance, "ranking_id": loaded.rankings, "swimmer_sk": loaded.swimmers}.items():
        assert quality.duplicates(frame, [key]).isEmpty()


@pytest.mark.parametrize("stop", [2, 3, 4])
def test_a_swap_that_stops_anywhere(spark, raw_frame, monkeypatch, stop):
    """The process dies after a statement of the swap; the next load must end as if nothing had happened."""
    def state(database):
        wh = read_warehouse(spark, database)
        frames = [wh.swimmers, wh.events, wh.competitions, wh.performance, wh.rankings]
        return [values(f, *[c for c in f.columns if not c.endswith("_at")]) for f in frames]

    changed = [{**r, "Name": r["Name"] + " II"} for r in FIRST]
    calm, name = new_database(spark), new_database(spark)
    for database in (calm, name):
        run_load(spark, raw_frame(FIRST), database, "first", "2018-01-02")
    run_load(spark, raw_frame(changed), calm, "second", "2018-02-02")

    done = []
    statement, table = type(spark).sql, f"{name}.dim_swimmer"

    class Death(BaseException):
        pass

    def sql(self, query, *args, **more):
        mine = table in query and ("RENAME" in query or "DROP" in query) and armed
        if mine and len(done) >= stop:
            raise Death
        found = statement(self, query, *args, **more)
        if mine:
            done.append(query)
        return found

    armed = False
    monkeypatch.setattr(type(spark), "sql", sql)
    swap = load.overwrite_swap

    def armed_swap(*args):
        nonlocal armed
        armed = True
        swap(*args)

    monkeypatch.setattr(load, "overwrite_swap", armed_swap)
    try:
        run_load(spark, raw_frame(changed), name, "second", "2018-02-02")
    except Death:
        pass
    monkeypatch.undo()
    assert read_warehouse(spark, name).swimmers.count() >= 2  # never an empty dimension
    third = [swim(9, "50m Freestyle", "29.00", "M3", "2018-03-01")]
    for database in (name, calm):
        run_load(spark, raw_frame(changed), database, "second", "2018-02-02")
        run_load(spark, raw_frame(third), database, "third", "2018-03-02")
    assert state(name) == state(calm)


def test_facts_without_their_dimension_are_refused(spark, raw_frame):
    name = new_database(spark)
    run_load(spark, raw_frame(FIRST), name, "first", "2018-01-02")
    spark.sql(f"DROP TABLE {name}.dim_swimmer")
    with pytest.raises(RuntimeError, match="dim_swimmer"):
        run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")


def test_files_are_loaded_once(spark, raw_frame, tmp_path):
    path, name = str(tmp_path / "in"), new_database(spark)
    write_results(raw_frame(FIRST), path)
    assert load_files(spark, path, name, "one", "2018-03-01")[0].performance.count() == 3
    loaded, profile = load_files(spark, path, name, "two", "2018-03-01")
    assert loaded.performance.count() == 3 and profile.count() == 0
    write_results(raw_frame(SECOND), path)
    loaded, profile = load_files(spark, path, name, "two", "2018-03-01")
    assert loaded.performance.count() == 6 and profile.count() == 1
    assert load_files(spark, path, name, "one", "2018-03-01")[0].performance.count() == 6


def test_a_load_that_broke_off_never_shares_keys(spark, raw_frame, monkeypatch):
    name = new_database(spark)
    run_load(spark, raw_frame(FIRST), name, "first", "2018-01-02")
    store = load.replace_load

    def break_off(rows, table, load_id):
        if table.endswith("fact_swimming_performance"):
            raise RuntimeError("lost")
        store(rows, table, load_id)

    monkeypatch.setattr(load, "replace_load", break_off)
    with pytest.raises(RuntimeError):
        run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")
    monkeypatch.setattr(load, "replace_load", store)
    third = [swim(4, "50m Freestyle", "29.00", "M3", "2018-03-01")]
    run_load(spark, raw_frame(third), name, "third", "2018-03-02")
    loaded = run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")
    assert loaded.performance.count() == 3 + 3 + 1
    keyed = {"performance_id": loaded.performance, "ranking_id": loaded.rankings, "swimmer_sk": loaded.swimmers}
    for key, frame in keyed.items():
        assert quality.duplicates(frame, [key]).isEmpty()
    assert quality.duplicates(loaded.rankings, ["swimmer_sk", "event_sk"]).isEmpty()


def test_loads_leave_nothing_behind(spark, raw_frame, tmp_path):
    folder = Path(shared_folder(spark))
    write_results(raw_frame(FIRST), str(tmp_path / "in"))
    name = new_database(spark)
    before = set(folder.iterdir())
    run_load(spark, raw_frame(FIRST), name, "first", "2018-01-02")
    run_load(spark, raw_frame(SECOND), name, "second", "2018-02-02")
    assert set(folder.iterdir()) == before
    _, profile = load_files(spark, str(tmp_path / "in"), name, "third", "2018-03-01")
    left = [p.name.split("-")[0] for p in set(folder.iterdir()) - before]
    assert left == ["profile"] and profile.count() == 1


def test_changed_competition_keeps_its_key(spark, raw_frame):
    first = dims.competitions(raw_frame(FIRST + SECOND)).whole()
    known = spark.createDataFrame(first.collect(), first.schema)
    moved = [swim(1, "50m Freestyle", "25.00", meet, "2018-03-01") for meet in ("M2", "M0")]
    assert not dims.competitions(raw_frame(FIRST), known).rewrites
    change = dims.competitions(raw_frame(moved), known)
    assert change.rewrites
    found = values(change.whole(), "competition_id", "competition_sk", "competition_date")
    assert found == [("M0", 3, dt.date(2018, 3, 1)), ("M1", 1, dt.date(2018, 1, 1)), ("M2", 2, dt.date(2018, 3, 1))]


def test_load_from_files(spark, raw_frame, tmp_path):
    write_results(raw_frame(FIRST + FIRST + SECOND), str(tmp_path / "in"))
    loaded, profile = load_files(spark, str(tmp_path / "in"), new_database(spark), "one", "2018-03-01")
    # Swimmer 2 comes with two nationalities in one feed: both rows are current, and each swim has its own.
    # The relay has no distance and so no event.
    assert loaded.performance.count() == 3 + 3 + 3
    swims = loaded.performance.join(loaded.swimmers, "swimmer_sk").filter("swimmer_id = 'SWM2'")
    assert values(swims, "nationality", "time_seconds") == [("CHN", 27.0), ("USA", 26.0), ("USA", 26.0)]
    assert profile.agg({"rows": "sum"}).first()[0] == 10
    assert quality.duplicates(loaded.swimmers.filter("is_current"), ["swimmer_id"]).count() == 1


def test_files_are_staged_in_the_columns_that_loads_use(raw_frame):
    rows = [{**row, "Sponsor": None if i % 2 else "x", "Top_5": "" if i else None, "Time": None} for i, row in enumerate(FIRST + SECOND)]
    raw = raw_frame(rows).withColumns({"source_file": F.col("Competition_Competition_Id"), "source_block": F.lit(0).cast("bigint")})
    staged = load._staged(raw)
    assert staged.columns == [*USED_COLUMNS, *SOURCE, load.NULLS]
    whole, found = quality.profile(raw, "source_file", RAW_COLUMNS), load._profile(staged)
    assert found.columns == whole.columns and whole.count() == 2
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_best_time_and_rank_are_independent(spark):
    schema = "swimmer_sk bigint, event_sk bigint, time_seconds double, overall_rank int"
    swims = spark.createDataFrame([(1, 1, 25.0, 3), (1, 1, 26.0, 1), (1, 2, None, None)], schema)
    assert values(facts.rankings(swims), "ranking_id", "swimmer_sk", "event_sk", "best_time", "best_rank") == [
        (1, 1, 1, 25.0, 1), (2, 1, 2, None, None)]


@pytest.fixture(scope="module")
def small(spark):
    return raw_results(spark, SMALL), warehouse(spark, SMALL)


def test_constraints_hold(small):
    raw, wh = small
    assert wh.performance.count() == raw.count()
    keys = {"swimmers": "swimmer_sk", "events": "event_sk", "competitions": "competition_sk"}
    for table, key in keys.items():
        dim = getattr(wh, table)
        assert quality.duplicates(dim, [key]).isEmpty()
        assert quality.orphans(wh.performance, dim, key).isEmpty()
        if key != "competition_sk":
            assert quality.orphans(wh.rankings, dim, key).isEmpty()
    assert quality.duplicates(wh.performance, ["performance_id"]).isEmpty()
    assert quality.duplicates(wh.rankings, ["ranking_id"]).isEmpty()
    assert quality.duplicates(wh.rankings, ["swimmer_sk", "event_sk"]).isEmpty()
    assert quality.duplicates(wh.swimmers.filter("is_current"), ["swimmer_id"], allow_null=True).isEmpty()
    assert quality.duplicates(wh.competitions, ["competition_id"], allow_null=True).isEmpty()
    for frame, name in [(wh.swimmers, "dim_swimmer"), (wh.events, "dim_event"), (wh.competitions, "dim_competition")]:
        assert quality.too_long(frame, TEXT_LIMITS[name]).filter("violations > 0").isEmpty()


def test_ids_do_not_depend_on_the_layout(spark, small):
    raw, wh = small
    again = facts.performance(raw.repartition(13), wh.swimmers, wh.events, wh.competitions, SRC)
    assert again.exceptAll(wh.performance).isEmpty() and wh.performance.exceptAll(again).isEmpty()
    assert wh.swimmers.filter(f"valid_from <> date'{AS_OF}' OR created_at IS NULL OR updated_at IS NULL").isEmpty()


def results_file(folder, name, rows, when):
    """A single results file as another program writes it, with its time of change."""
    import csv
    import os

    folder.mkdir(exist_ok=True)
    path = folder / f"{name}_results.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(RAW_COLUMNS)
        writer.writerows([["" if row.get(c) is None else row[c] for c in RAW_COLUMNS] for row in rows])
    os.utime(path, (when, when))
    return path


def times(loaded):
    swims = loaded.performance.join(loaded.swimmers, "swimmer_sk").join(loaded.competitions, "competition_sk")
    best = loaded.rankings.join(loaded.swimmers, "swimmer_sk").join(loaded.events, "event_sk")
    return values(swims, "swimmer_id", "competition_id", "time_seconds"), values(best, "swimmer_id", "distance", "best_time")


def test_corrected_files_replace_what_they_brought(spark, tmp_path):
    folder, name = tmp_path / "in", new_database(spark)

    def meet(number, time, swimmer=1):
        return [swim(swimmer, "50m Freestyle", time, f"M{number}", "2018-01-01")]

    paths = [results_file(folder, f"2018-01-01_M{i}", meet(i, f"2{i}.10"), 1_600_000_000) for i in range(5)]
    loaded, _ = load_files(spark, str(folder), name, "one", "2018-03-01")
    assert times(loaded)[1] == [("SWM1", 50, 20.1)]
    size = paths[0].stat().st_size
    results_file(folder, "2018-01-01_M0", meet(0, "25.10"), 1_600_000_500)  # as long as before
    assert paths[0].stat().st_size == size
    results_file(folder, "2018-01-01_M1", [*meet(1, "1:01.25"), *meet(1, "33.00", 2)], 1_600_000_500)  # longer
    paths[2].unlink()  # gone
    results_file(folder, "2018-01-01_M9", meet(9, "29.00"), 1_600_000_500)
    loaded, profile = load_files(spark, str(folder), name, "two", "2018-03-01")
    assert profile.count() == 3
    want = [("SWM1", "M0", 25.1), ("SWM1", "M1", 61.25), ("SWM1", "M2", 22.1), ("SWM1", "M3", 23.1), ("SWM1", "M4", 24.1),
            ("SWM1", "M9", 29.0), ("SWM2", "M1", 33.0)]
    assert times(loaded) == (want, [("SWM1", 50, 22.1), ("SWM2", 50, 33.0)])
    # Nothing changes when either load comes again, and a third version replaces the second.
    assert times(load_files(spark, str(folder), name, "three", "2018-03-01")[0])[0] == want
    assert times(load_files(spark, str(folder), name, "two", "2018-03-01")[0])[0] == want
    results_file(folder, "2018-01-01_M0", meet(0, "21.00"), 1_600_000_900)
    loaded, _ = load_files(spark, str(folder), name, "four", "2018-03-01")
    assert times(loaded) == ([("SWM1", "M0", 21.0), *want[1:]], [("SWM1", 50, 21.0), ("SWM2", 50, 33.0)])


def test_a_correction_that_broke_off_is_replaced_by_the_next(spark, tmp_path, monkeypatch):
    folder, name = tmp_path / "in", new_database(spark)
    one = [swim(1, "50m Freestyle", "25.00", "M0", "2018-01-01")]
    results_file(folder, "2018-01-01_M0", one, 1_600_000_000)
    load_files(spark, str(folder), name, "one", "2018-03-01")
    results_file(folder, "2018-01-01_M0", [{**one[0], "Time": "24.00"}], 1_600_000_500)
    monkeypatch.setattr(load, "_retire", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_files(spark, str(folder), name, "two", "2018-03-01")
    monkeypatch.undo()
    loaded, _ = load_files(spark, str(folder), name, "three", "2018-03-01")
    assert times(loaded) == ([("SWM1", "M0", 24.0)], [("SWM1", 50, 24.0)])


def test_writers_wait_for_each_other(spark, raw_frame, tmp_path):
    """Two sessions load at once, each without the other's lock in the process; keys stay distinct."""
    from concurrent.futures import ThreadPoolExecutor

    from lapstar.sources import lock

    name = new_database(spark)
    rows = [raw_frame(FIRST), raw_frame(SECOND)]
    run_load(spark, rows[0], name, "zero", "2018-01-02")

    def work(number):
        load._WRITERS.pop(name, None)  # as another process has it
        return run_load(spark.newSession(), rows[number], name, f"load-{number}", "2018-01-02")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(work, (0, 1)))
    loaded = read_warehouse(spark, name)
    assert loaded.performance.count() == 9 and quality.duplicates(loaded.performance, ["performance_id"]).isEmpty()
    with lock.writer(spark, str(tmp_path)):
        with pytest.raises(TimeoutError, match="another writer"), lock.writer(spark, str(tmp_path), patience=0.5):
            pass
    # A lock that nobody renews is taken away, once.
    dead = lock._File(spark, str(tmp_path))
    assert dead.create() and not lock._File(spark, str(tmp_path)).create()
    with lock.writer(spark, str(tmp_path), lease=0.5, patience=20):
        assert not dead.mine()
        dead.release()
        time.sleep(1.0)
        with pytest.raises(TimeoutError), lock.writer(spark, str(tmp_path), lease=0.5, patience=1.0):
            pass
    assert not (tmp_path / lock.NAME).exists() and not list(tmp_path.iterdir())
    with pytest.raises(RuntimeError, match="taken away"), lock.writer(spark, str(tmp_path), lease=30):
        (tmp_path / lock.NAME).unlink()


def test_what_only_orders_swims_is_not_written(raw_frame, monkeypatch):
    written = []

    def save(df, label):
        written.append((label, df.columns))
        return df.localCheckpoint()

    monkeypatch.setattr(keys, "save", save)
    raw = raw_frame([{**row, "Sponsor": f"{i:03}"} for i, row in enumerate(FIRST + SECOND)])
    wide, slim = (facts.numbered_swims(raw, ["Sponsor"], attributes) for attributes in (True, False))
    assert not {"Sponsor", "distance", "stroke"} & set(written[0][1])
    assert not {"Sponsor", "name", "birth_date", "gender", "nationality", "distance", "stroke"} & set(written[1][1])
    columns = ["performance_id", "swimmer_id", "competition_id", "distance", "stroke", "time_seconds"]
    assert sorted(wide.select(*columns).collect(), key=str) == sorted(slim.select(*columns).collect(), key=str)
    assert wide.columns != slim.columns and wide.count() == len({row[0] for row in slim.select("performance_id").collect()})


def test_rankings_get_known_and_new_ids_from_one_join(spark):
    best = spark.createDataFrame(
        [(1, 1, 20.0, 3), (1, 2, None, None), (2, 1, 21.0, 1)], "swimmer_sk long, event_sk long, best_time double, best_rank int"
    )
    ids = spark.createDataFrame([(7, 1, 2), (8, 9, 9)], "ranking_id long, swimmer_sk long, event_sk long")
    found = facts.with_ids(best, ids)
    assert [tuple(row) for row in facts.known_rankings(found).collect()] == [(7, 1, 2, None, None)]
    fresh = sorted(tuple(row) for row in facts.new_rankings(found, 8).collect())
    assert fresh == [(9, 1, 1, 20.0, 3), (10, 2, 1, 21.0, 1)]


def test_rows_that_differ_are_counted_with_repeats(spark):
    schema = "a int, b string"
    old = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y")], schema)
    new = spark.createDataFrame([(1, "x"), (1, None), (1, None), (1, None), (3, "z")], schema)
    assert queries._differing(old, new).first()["differing"] == 5
    assert queries._differing(old, old).first()["differing"] == 0
    assert queries._differing(old.limit(0), new.limit(0)).first()["differing"] == 0
    plan = queries._differing(old, new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
