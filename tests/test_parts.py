"""Loads that are merged in tiers: the same rows, few parts, and any load still replaceable."""

import pytest
from conftest import swim
from pyspark.sql import functions as F

from lapstar.plans.load import compact, load_files
from lapstar.sources import parts
from lapstar.sources.tables import replace_load
from lapstar.streaming import files as streaming
from test_load import results_file, times
from workload.staging import new_database

TABLES = {"facts": lambda rows: rows, "sums": lambda rows: minima(rows)}


def minima(rows):
    return rows.groupBy("k").agg(F.min("x").alias("x"))


def put(spark, database, load, values):
    rows = spark.createDataFrame([(v % 3, v, load) for v in values], "k int, x int, brought_by string").coalesce(1)
    replace_load(rows, f"{database}.facts", load)
    replace_load(minima(rows), f"{database}.sums", load)


def state(spark, database):
    facts, count = parts.read(spark, database, "facts")
    sums, _ = parts.read(spark, database, "sums")
    found = sorted((r.brought_by, r.x) for r in facts.collect())
    assert sorted(map(tuple, minima(sums).collect())) == sorted(map(tuple, minima(facts).collect()))
    return found, count


def test_tiers_keep_rows_and_bound_parts(spark):
    name, want = new_database(spark), []
    for i in range(11):
        put(spark, name, f"l{i}", [i, 100 + i])
        want += [(f"l{i}", i), (f"l{i}", 100 + i)]
        parts.merge(spark, name, TABLES, 3)
        found, count = state(spark, name)
        assert found == sorted(want) and count <= 2 * 3  # fewer than three a tier
    assert {parts.tier(p) for p in parts.live(spark, name, ["facts"])} == {0, 2}
    on_disk = parts.stored(spark, name, ["facts"])
    assert len(on_disk) <= 11  # parts that no longer count wait for one merge only
    assert not parts.due(spark, name, ["facts"], 3)


def test_a_full_tier_is_merged_with_the_one_it_fills(spark):
    name, want = new_database(spark), []
    for i in range(4):
        put(spark, name, f"l{i}", [i, 50 + i])
        want += [(f"l{i}", i), (f"l{i}", 50 + i)]
        merges = parts.merge(spark, name, TABLES, 2)
    assert merges == 1 and [parts.tier(p) for p in parts.live(spark, name, ["facts"])] == [2]
    assert state(spark, name) == (sorted(want), 1)


def test_stored_rows_are_merged_without_a_shuffle(spark, monkeypatch):
    name = new_database(spark)
    for i in range(3):
        put(spark, name, f"l{i}", range(i, 200, 3))
    stored = spark.read.table(f"{name}.facts").filter(F.col("load_id") != "l0")
    packed = parts._packed(stored)
    assert packed.rdd.getNumPartitions() == 1 and "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.exceptAll(stored).isEmpty() and stored.exceptAll(packed).isEmpty()
    monkeypatch.setattr(parts, "FILE_BYTES", 1)
    assert parts._packed(stored).rdd.getNumPartitions() == 2  # two parts of one file each; the third is not counted
    assert parts._packed(stored).count() == stored.count() and parts._packed(stored.limit(0)).count() == 0
    used, packer = [], parts._packed
    monkeypatch.setattr(parts, "_packed", lambda rows: used.append(rows.columns) or packer(rows))
    assert parts.merge(spark, name, TABLES, 3) == 1
    assert used == [["k", "x", "brought_by", "load_id"]]  # the facts; sums are grouped
    assert len(state(spark, name)[0]) == 200


def test_a_merge_that_stops_changes_nothing(spark, monkeypatch):
    name = new_database(spark)
    for i in range(3):
        put(spark, name, f"l{i}", [i])
    before, place = state(spark, name), parts._place
    monkeypatch.setattr(parts, "_place", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        parts.merge(spark, name, TABLES, 3)
    assert len(parts.stored(spark, name, ["facts"])) == 4 and state(spark, name) == before
    monkeypatch.setattr(parts, "_place", place)
    assert parts.merge(spark, name, TABLES, 3) == 1
    assert state(spark, name) == (before[0], 1)


def test_a_reader_sees_the_loads_as_they_were(spark):
    name = new_database(spark)
    for i in range(3):
        put(spark, name, f"l{i}", [i])
    began, _ = parts.read(spark, name, "facts")
    parts.merge(spark, name, TABLES, 3)
    assert began.count() == 3 and state(spark, name)[1] == 1


def test_a_merged_load_is_taken_out_and_replaced(spark, monkeypatch):
    name = new_database(spark)
    for i in range(4):
        put(spark, name, f"l{i}", [i, 10 * i + 5])
    parts.merge(spark, name, TABLES, 4)
    before = state(spark, name)[0]
    place = parts._place
    monkeypatch.setattr(parts, "_place", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        parts.reopen(spark, name, TABLES, ["l1", "l3"], "facts")
    assert state(spark, name) == (before, 1)
    monkeypatch.setattr(parts, "_place", place)
    parts.reopen(spark, name, TABLES, ["l1", "l3", "unknown"], "facts")
    assert state(spark, name) == (before, 3)
    put(spark, name, "l1", [77])
    want = sorted([row for row in before if row[0] != "l1"] + [("l1", 77)])
    assert state(spark, name)[0] == want
    parts.merge(spark, name, TABLES, 2)
    assert state(spark, name)[0] == want


def test_reserved_names_and_small_fanout(spark):
    with pytest.raises(ValueError):
        parts.check("merged.1.x")
    with pytest.raises(ValueError):
        parts.merge(spark, "any", TABLES, 1)
    assert parts.live(spark, new_database(spark), ["facts"]) == []


def test_files_of_merged_loads_are_known_and_corrected(spark, tmp_path):
    folder, name = tmp_path / "in", new_database(spark)

    def meet(number, time):
        results_file(folder, f"2018-01-01_M{number}", [swim(1, "50m Freestyle", time, f"M{number}", "2018-01-01")],
                     1_600_000_000 + 100 * (time < "25"))

    for number in range(2):
        meet(number, f"2{number + 5}.00")
        load_files(spark, str(folder), name, f"load-{number}", "2018-03-01")
    assert compact(spark, name, 2) == 1
    meet(0, "24.00")
    loaded, profile = load_files(spark, str(folder), name, "third", "2018-03-01")
    assert profile.count() == 1
    assert times(loaded) == ([("SWM1", "M0", 24.0), ("SWM1", "M1", 26.0)], [("SWM1", 50, 24.0)])


def test_folders_of_the_rankings_stream_fold(spark, tmp_path):
    sink = str(tmp_path / "sink")
    schema = "swimmer_id string, event string, best_time double, best_rank int"

    def write(batch, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    write(0, [("a", "e", 3.0, 2), ("b", "e", None, 1)])
    write(1, [("a", "e", 2.0, None)])
    want = sorted(map(str, streaming.current_rankings(spark, sink).collect()))
    for _ in range(2):  # also when a batch comes again
        streaming.fold_rankings(spark, sink, 1)
        assert [p.name for p in (tmp_path / "sink").glob("batch=*")] == ["batch=-2"]
        assert sorted(map(str, streaming.current_rankings(spark, sink).collect())) == want
        write(1, [("a", "e", 2.0, None)])
    assert sorted(map(str, streaming.current_rankings(spark, sink).collect())) == want
