"""Tables written to the shared folder."""

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lapstar import session
from lapstar.sources.files import read_results, read_summary, write_results, write_summary
from lapstar.sources.tables import append, overwrite_swap, replace_load
from workload.staging import new_database


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that are there for good; those that go do so in the background."""
    until = time.time() + 10
    while (found := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return found


def shuffled(spark, rows=1000):
    return spark.range(rows).select("id", F.lit("x").alias("v")).repartition(3, "id")


def test_written_rows_leave_no_shuffles(spark, raw_frame, tmp_path):
    name, before = new_database(spark), shuffles(spark)
    assert session.save(shuffled(spark)).count() == 1000
    replace_load(shuffled(spark), f"{name}.loads", "a")
    append(shuffled(spark), f"{name}.rows")
    overwrite_swap(shuffled(spark, 5), f"{name}.rows")
    rows = raw_frame([{"SwimmerId": "a", "Competition_Date": "2018-01-01", "Competition_Competition_Id": f"C{i}"} for i in range(9)])
    write_results(rows, str(tmp_path / "results"))
    assert not left(spark, before)
    assert spark.read.table(f"{name}.loads").count() == 1000 and spark.read.table(f"{name}.rows").count() == 5
    assert read_results(spark, str(tmp_path / "results")).count() == 9


def test_the_setting_is_put_back_when_the_last_writer_is_done(spark):
    before = spark.conf.get(session.CLEANUP, None)

    def write(_):
        with session.shuffles_dropped(spark):
            assert spark.conf.get(session.CLEANUP) == "true"
            return session.save(shuffled(spark, 20)).count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(write, range(8))) == [20] * 8
    assert spark.conf.get(session.CLEANUP, None) == before
    spark.conf.set(session.CLEANUP, "false")
    try:
        write(0)
        assert spark.conf.get(session.CLEANUP) == "false"
    finally:
        spark.conf.unset(session.CLEANUP) if before is None else spark.conf.set(session.CLEANUP, before)


def test_a_compressed_summary_is_read_as_a_plain_one(spark, tmp_path):
    from lapstar.operators.results import SUMMARY_ATTRIBUTES

    ids = spark.createDataFrame([("a",), (None,)], "id string")
    summary = ids.select(
        "id", *[F.lit('"x", y').alias(c) for c in list(SUMMARY_ATTRIBUTES)[1:]], F.lit("Butterfly").alias("Stroke"),
        *[F.lit(k).cast("bigint").alias(f"Rank{k}_Count") for k in range(1, 6)],
        F.create_map(F.lit(50), F.array(F.lit(25.3))).alias("Historical_Records"),
    )
    write_summary(summary, str(tmp_path / "plain"))
    write_summary(summary, str(tmp_path / "packed"), compression="gzip")
    assert list((tmp_path / "packed").glob("*.csv.gz")) and not list((tmp_path / "packed").glob("*.csv"))
    plain, packed = (sorted(map(str, read_summary(spark, str(tmp_path / x)).collect())) for x in ("plain", "packed"))
    assert plain == packed and len(packed) == 2
