import os
import threading
import time

import pytest
from conftest import swim

from lapstar.plans.load import read_warehouse
from lapstar.schemas import RAW, SOURCE, USED_COLUMNS
from lapstar.sources.files import write_results
from lapstar.streaming import files as streaming
from workload.staging import new_database

FIRST = [
    swim(1, "50m Freestyle", "25.00", "M1", "2018-01-01", Overall_Rank="2"),
    swim(2, "50m Freestyle", "DNS", "M1", "2018-01-01", Overall_Rank="3"),
]
SECOND = [
    swim(1, "50m Freestyle", "24.50", "M2", "2018-02-01", Overall_Rank="4"),
    swim(3, "100m Freestyle", "1:01.00", "M2", "2018-02-01"),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_file_is_taken_once(spark, raw_frame, tmp_path):
    path, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    write_results(raw_frame(FIRST), path)
    assert streaming.ingest(spark, path, sink, progress).count() == 2
    write_results(raw_frame(SECOND), path)
    assert streaming.ingest(spark, path, sink, progress).count() == 4
    assert rows(streaming.ingest(spark, path, sink, progress)) == rows(raw_frame(FIRST + SECOND))


def test_no_files_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    streaming.load_stream(spark, str(tmp_path / "in"), "never_made", str(tmp_path / "progress"))
    assert not spark.catalog.databaseExists("never_made")


def test_stream_load_equals_batch(spark, raw_frame, tmp_path):
    path, progress, database = str(tmp_path / "in"), str(tmp_path / "progress"), new_database(spark)
    for part in (FIRST, SECOND):
        write_results(raw_frame(part), path)
        streaming.load_stream(spark, path, database, progress, "2018-03-01")
    loaded = read_warehouse(spark, database)
    assert [len(rows(f)) for f in (loaded.swimmers, loaded.events, loaded.competitions)] == [3, 2, 2]
    assert sorted(r.time_seconds or 0 for r in loaded.performance.collect()) == [0, 24.5, 25.0, 61.0]
    best = loaded.rankings.join(loaded.swimmers, "swimmer_sk").select("swimmer_id", "best_time", "best_rank")
    assert rows(best) == [("SWM1", 24.5, 2), ("SWM2", None, 3), ("SWM3", 61.0, 1)]


def test_a_batch_holds_what_loads_use_and_headers_are_checked_whole(spark, raw_frame, tmp_path, monkeypatch):
    path, database, kept = tmp_path / "in", new_database(spark), []
    save = streaming.save
    monkeypatch.setattr(streaming, "save", lambda df, label: kept.append(df.columns) or save(df, label))
    write_results(raw_frame(FIRST), str(path))
    streaming.load_stream(spark, str(path), database, str(tmp_path / "progress"), "2018-03-01")
    assert kept == [[*USED_COLUMNS, *SOURCE]] and read_warehouse(spark, database).performance.count() == 2
    names = [{"Sponsor": "Other"}.get(name, name) for name in RAW.names]
    (path / "2018-02-01_M3_results.csv").write_text(",".join(names) + "\n" + "," * (len(names) - 1) + "\n")
    with pytest.raises(Exception, match="header"):
        streaming.load_stream(spark, str(path), database, str(tmp_path / "progress"), "2018-03-01")


def test_rankings_follow_the_files(spark, raw_frame, tmp_path):
    path, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    write_results(raw_frame(FIRST), path)
    streaming.rankings_stream(spark, path, sink, progress)
    write_results(raw_frame(SECOND), path)
    found = streaming.rankings_stream(spark, path, sink, progress, max_files=1)
    assert rows(found) == [
        ("SWM1", "50m Freestyle", 24.5, 2), ("SWM2", "50m Freestyle", None, 3), ("SWM3", "100m Freestyle", 61.0, 1)]


def test_polling_takes_files_as_they_come(spark, raw_frame, tmp_path):
    path, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    worker = threading.Thread(
        target=streaming.ingest, args=(spark, path, sink, progress), kwargs={"every": "1 second"}
    )
    worker.start()
    try:
        for part, expected in ((FIRST, 2), (SECOND, 4)):
            write_results(raw_frame(part), path)
            wait_until(lambda: any(q.lastProgress for q in spark.streams.active) and rows_in(spark, sink) == expected)
    finally:
        for query in spark.streams.active:
            query.stop()
        worker.join(30)
    assert not worker.is_alive()


def rows_in(spark, sink):
    return spark.read.schema(RAW).parquet(sink).count() if os.path.isdir(f"{sink}/_spark_metadata") else 0


def wait_until(done, seconds=60):
    deadline = time.monotonic() + seconds
    while not done():
        assert time.monotonic() < deadline
        time.sleep(0.5)


def test_archive_never_loses_rows(spark, raw_frame, tmp_path):
    path, sink, progress, archive = (str(tmp_path / n) for n in ("in", "out", "progress", "archive"))
    for i, part in enumerate((FIRST, SECOND, FIRST)):
        write_results(raw_frame([{**row, "Competition_Competition_Id": f"M{i}"} for row in part]), path)
        taken = streaming.ingest(spark, path, sink, progress, archive=archive)
    assert taken.count() == 6
    left = len(list((tmp_path / "in").rglob("*.csv")) + list((tmp_path / "archive").rglob("*.csv")))
    assert left >= 3
