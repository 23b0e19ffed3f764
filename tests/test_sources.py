import pytest
from conftest import SMALL, settings, swim
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from lapstar.schemas import FACT_RANKINGS, RAW, RAW_COLUMNS
from lapstar.sources import files, jdbc, tables
from workload.staging import raw_results


def database(spark, tmp_path, name):
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / name}'")
    return name


SWIMS = [
    swim(1, "50m Butterfly", "25.30", "NAT_001", "2025-12-03 19:43:00.1", Sponsor="None", Club='The "Fast", one'),
    swim(2, "50m Butterfly", None, "NAT_001", "2025-12-03 19:43:00.1", Historical_Times="['25.30', '1:02.33']"),
    swim(1, "50m Butterfly", "26.00", "LOC_002", "2025-12-10", Name="  Blanks ", Sponsor="back\\slash"),
]


def test_results_come_back_as_written(raw_frame, spark, tmp_path):
    raw = raw_frame(SWIMS)
    files.write_results(raw, str(tmp_path / "out"))
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert names == ["results=20251203_NAT_001_results.csv", "results=20251210_LOC_002_results.csv"]
    back = files.read_results(spark, str(tmp_path / "out"))
    assert back.schema == RAW
    assert sorted(back.collect(), key=str) == sorted(raw.collect(), key=str)


def test_compressed_results_come_back_as_written(raw_frame, spark, tmp_path):
    raw, path = raw_frame(SWIMS), str(tmp_path / "out")
    files.write_results(raw, path, compression="gzip")
    assert [f.suffixes[-2:] for f in (tmp_path / "out").rglob("part-*")] == [[".csv", ".gz"]] * 2
    found = files.read_results(spark, path)
    assert found.exceptAll(raw).isEmpty() and raw.exceptAll(found).isEmpty()
    assert files.holds_results(spark, path) and not files.holds_results(spark, str(tmp_path / "other"))


def test_a_large_competition_is_written_by_several_tasks(spark, tmp_path):
    one = raw_results(spark, SMALL).withColumns(
        {"Competition_Competition_Id": F.lit("HOT"), "Competition_Date": F.lit("2018-01-01")}
    )
    small_steps = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "4"}
    with settings(spark, small_steps):
        files.write_results(one.repartition(8), str(tmp_path / "out"))
    folder = tmp_path / "out" / "results=20180101_HOT_results.csv"
    assert len(list(folder.glob("*.csv"))) > 2
    assert files.read_results(spark, str(tmp_path / "out")).count() == 6000


def test_single_files_are_read_and_others_are_not(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    row = ",".join(f'"a ""quoted"", cell {i}"' if i == 1 else "" if i == 2 else str(i) for i in range(29))
    (tmp_path / "20250101_NAT_001_results.csv").write_text(f"{header}\n{row}\n")
    (tmp_path / "20250102_NAT_002_results.csv").write_text(f"{header}\n{row}\n{row}\n")
    sample = b"SwimmerId,Name,Birth_Date,Education_Level\r\nSWM001,A,2000-01-01,MBA\r\n"
    (tmp_path / "people.csv").write_bytes(sample)
    (tmp_path / "summary.csv").write_text("id\n1\n")
    raw = files.read_results(spark, str(tmp_path), with_source=True)
    found = raw.collect()
    assert len(found) == 3
    assert found[0].Name == 'a "quoted", cell 1' and found[0].Birth_Date is None and found[0].SwimmerId == "0"
    assert len({r.source_file for r in found}) == 2 and {r.source_block for r in found} == {0}


def test_missing_input_is_an_error(spark, tmp_path):
    for path in (tmp_path / "nowhere", tmp_path):
        with pytest.raises(FileNotFoundError):
            files.read_results(spark, str(path))


def test_a_wrong_header_is_an_error(spark, tmp_path):
    header = ",".join(reversed(RAW_COLUMNS))
    (tmp_path / "20250101_NAT_001_results.csv").write_text(f"{header}\n{',' * 28}\n")
    with pytest.raises(Exception, match="header"):
        files.read_results(spark, str(tmp_path)).collect()


def test_missing_tables(spark, tmp_path):
    name = database(spark, tmp_path, "missing_tables")
    assert tables.read_table(spark, f"{name}.nothing") is None
    empty = tables.read_table(spark, f"{name}.nothing", FACT_RANKINGS)
    assert empty.schema == FACT_RANKINGS and empty.count() == 0


def test_swap_from_the_tables_own_rows(spark, tmp_path):
    name = f"{database(spark, tmp_path, 'swaps')}.t"
    tables.overwrite_swap(spark.range(10), name)
    tables.overwrite_swap(spark.read.table(name).filter("id < 4"), name)
    tables.append(spark.range(100, 102), name)
    assert sorted(r.id for r in spark.read.table(name).collect()) == [0, 1, 2, 3, 100, 101]
    assert [t.name for t in spark.catalog.listTables("swaps") if not t.isTemporary] == ["t"]


def test_a_failed_swap_keeps_the_old_table(spark, tmp_path):
    name = f"{database(spark, tmp_path, 'failed_swaps')}.t"
    tables.overwrite_swap(spark.range(3), name)
    with pytest.raises(Exception):
        tables.overwrite_swap(spark.read.table(name).selectExpr("raise_error('broken') AS id"), name)
    assert spark.read.table(name).count() == 3
    tables.overwrite_swap(spark.range(5), name)
    assert spark.read.table(name).count() == 5


def test_a_load_replaces_only_itself(spark, tmp_path):
    name = f"{database(spark, tmp_path, 'loads')}.t"
    tables.replace_load(spark.range(3), name, "first")
    tables.replace_load(spark.range(10, 12), name, "second")
    tables.replace_load(spark.range(20, 24), name, "second")
    assert sorted(r.id for r in spark.read.table(name).collect()) == [0, 1, 2, 20, 21, 22, 23]
    with pytest.raises(ValueError):
        tables.replace_load(spark.range(1), name, "x') --")


def test_jdbc_options(spark, monkeypatch):
    """No database is started: the calls must reach Spark's own reader and writer as documented."""
    calls = []
    reader, writer = type(spark.read), type(spark.range(1).write)
    monkeypatch.setattr(reader, "jdbc", lambda self, url, table, **kw: calls.append((url, table, kw)) or "frame")
    monkeypatch.setattr(writer, "jdbc", lambda self, url, table, **kw: calls.append((url, table, kw)))
    assert jdbc.read_jdbc(spark, "jdbc:x", "t", column="k", bounds=(0, 9), partitions=4) == "frame"
    jdbc.write_jdbc(spark.range(1), "jdbc:x", "t", "overwrite", {"user": "u"})
    jdbc.write_jdbc(spark.range(1), "jdbc:x", "t")
    assert calls == [
        ("jdbc:x", "t", {"properties": {}, "column": "k", "lowerBound": 0, "upperBound": 9, "numPartitions": 4}),
        ("jdbc:x", "t", {"mode": "overwrite", "properties": {"truncate": "true", "user": "u"}}),
        ("jdbc:x", "t", {"mode": "append", "properties": {}}),
    ]


def test_jdbc_errors(spark, monkeypatch):
    with pytest.raises(Py4JJavaError, match="driver"):
        jdbc.read_jdbc(spark, "jdbc:nosuchdriver:x", "t")

    def fail_with(state):
        def read(self, url, table, **options):
            raise Py4JJavaError("failed", spark._jvm.java.sql.SQLException("failed", state))

        monkeypatch.setattr(type(spark.read), "jdbc", read)

    fail_with("42P01")
    assert jdbc.read_jdbc(spark, "jdbc:x", "t") is None
    fail_with("08001")
    with pytest.raises(Py4JJavaError):
        jdbc.read_jdbc(spark, "jdbc:x", "t")


def test_columns_are_found_by_name(spark, tmp_path):
    from lapstar.schemas import RAW_COLUMNS, USED_COLUMNS
    from lapstar.sources.files import read_by_name

    values = {name: f"{name}, x" for name in RAW_COLUMNS}
    layouts = {"a": RAW_COLUMNS, "b": USED_COLUMNS[::-1], "c": ["More", *USED_COLUMNS], "d": USED_COLUMNS[::-1]}
    for name, columns in layouts.items():
        cells = ",".join(f'"{values.get(c, "more")}"' for c in columns)
        (tmp_path / f"{name}_results.csv").write_text(",".join(columns) + "\n" + cells + "\n")
    rows = read_by_name(spark, str(tmp_path), with_source=True).collect()
    assert len(rows) == 4
    for row in rows:
        columns = layouts[row["source_file"].rsplit("/", 1)[1][0]]
        assert {c: row[c] for c in RAW_COLUMNS} == {c: values[c] if c in columns else None for c in RAW_COLUMNS}
    (tmp_path / "e_results.csv").write_text(",".join(USED_COLUMNS[1:]) + "\n")
    with pytest.raises(ValueError, match="SwimmerId"):
        read_by_name(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_by_name(spark, str(tmp_path / "none"))
