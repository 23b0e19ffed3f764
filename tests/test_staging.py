import datetime as dt

from lapstar import session
from lapstar.operators import scans
from workload import staging

CUSTOMERS = [(3, "C3", 1, "BUILDING"), (4, "C4", None, None), (5, None, 24, "MACHINERY"), (5, None, 24, "MACHINERY"),
             (None, "lost", 2, "AUTO")]
ORDERS = [(10, 3, dt.datetime(1996, 3, 17)), (11, 4, dt.datetime(1996, 3, 1)), (12, 5, None), (13, None, dt.datetime(1997, 1, 2)),
          (14, 5, dt.datetime(1996, 3, 9)), (14, 5, dt.datetime(1996, 3, 9))]
PARTS = [(1, "PROMO", 4), (2, None, 1), (3, "SMALL", None), (4, "LARGE", -2), (None, "MEDIUM", 3)]


def write(spark, folder):
    lines = [
        (order, part, 7 + part, line, float(1000 * part + 61007 * line), tax, flag)
        for order in (10, 11, 12, 13, 14, None)
        for part in (1, 2, 3, 4)
        for line, tax, flag in ((1, 0.0, "R"), (6, 0.0, "N"), (6, None, "R"), (7, 0.1, "R"), (7, 0.1, None))
    ] + [(10, 1, 9, 7, None, 0.1, "N"), (None, None, 1, 1, 5.0, 0.0, "R")]
    schemas = {
        "customer": (CUSTOMERS, "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": (ORDERS, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
        "part": (PARTS, "p_partkey bigint, p_type string, p_size int"),
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                            " l_extendedprice double, l_tax double, l_returnflag string"),
    }
    for name, (rows, schema) in schemas.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_stage_gives_the_rows_of_its_sql_from_narrow_ones(spark, tmp_path, monkeypatch):
    write(spark, tmp_path)
    for name in staging.TABLES:
        staging.table(spark, tmp_path, name).createOrReplaceTempView(name)
    expected = spark.sql(staging.STAGING_SQL)
    placed = []

    def number(df, *rest):
        placed.append(df)
        return scans.number_in_groups(df, *rest)

    monkeypatch.setattr(staging, "number_in_groups", number)
    found = staging.stage(spark, tmp_path)
    assert found.schema.names == expected.schema.names
    assert expected.count() > 50
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    # What is shuffled for the places: nothing that a key, a month or a time gives again, and no text but the customer's.
    assert {name for name, kind in placed[0].dtypes if kind == "string"} == {"c_name", "c_mktsegment"}
    assert not {"off", "age", "foreigner", "cdate", "mon", "cs", "l_tax", "l_returnflag"} & set(placed[0].columns)


def test_raw_results_are_made_in_as_many_partitions_as_their_rows_need(spark, tmp_path, monkeypatch):
    write(spark, tmp_path)
    monkeypatch.setattr(session, "TASK_ROWS", 10, raising=False)
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    used = []

    def stage(*args):
        used.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return made(*args)

    made = staging.stage
    monkeypatch.setattr(staging, "stage", stage)
    raw = staging.raw_results(spark, str(tmp_path))
    rows = staging.table(spark, tmp_path, "lineitem").count()
    assert used == [-(-rows // 10)] and used[0] > int(before["spark.sql.shuffle.partitions"])
    assert raw.exceptAll(made(spark, tmp_path)).isEmpty() and raw.count() > 50
    assert {key: spark.conf.get(key) for key in before} == before
