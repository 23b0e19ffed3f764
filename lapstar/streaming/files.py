"""Results files as a stream: every file is taken once, then the query stops until it is called again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lapstar.functions.columns import as_int, parse_time
from lapstar.plans.load import FANOUT, compact, run_load
from lapstar.schemas import RAW, SOURCE, USED_COLUMNS, Warehouse
from lapstar.session import save, scratch
from lapstar.sources.files import CSV_OPTIONS, add_source, results_glob


def results_stream(
    spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None, whole: bool = False
) -> DataFrame:
    """New results files of a folder.

    ``max_files`` bounds a batch. ``archive`` is a folder outside ``path`` to move files to after use; Spark
    does that later and without promise, and never needs it to know which files are done. With ``whole`` the headers are
    checked as a whole, also by readers that take some of the columns.
    """
    reader = spark.readStream.schema(RAW).options(**CSV_OPTIONS).option("columnPruning", str(not whole).lower())
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(results_glob(path))


def _run(writer: DataStreamWriter, checkpoint: str, every: str | None) -> None:
    """Take what has arrived and return, or, with ``every`` such as ``5 minutes``, keep polling."""
    trigger = {"processingTime": every} if every is not None else {"availableNow": True}
    writer.option("checkpointLocation", checkpoint).trigger(**trigger).start().awaitTermination()


def ingest(
    spark: SparkSession,
    path: str,
    sink: str,
    checkpoint: str,
    max_files: int | None = None,
    archive: str | None = None,
    every: str | None = None,
) -> DataFrame:
    """Append the raw rows of new files to a Parquet folder; returns all of it."""
    stream = results_stream(spark, path, max_files, archive)
    _run(stream.writeStream.format("parquet").option("path", sink), checkpoint, every)
    return spark.read.schema(RAW).parquet(sink)


def load_stream(
    spark: SparkSession,
    path: str,
    database: str,
    checkpoint: str,
    as_of: dt.date | str | None = None,
    max_files: int | None = None,
    archive: str | None = None,
    every: str | None = None,
    label: str = "batch",
    fanout: int = FANOUT,
) -> None:
    """Load new files into the warehouse. A batch that is repeated after a failure replaces its own swims.

    Batches are known by ``label`` and number: each stream into one warehouse needs a label of its own. From ``fanout`` batches
    on they are merged as ``compact`` does, so that the number of their files stays small.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch(session):
            rows = save(batch, "batch")
            if not rows.isEmpty():
                run_load(session, rows, database, f"{label}-{batch_id}", as_of)
                compact(session, database, fanout)

    # A batch comes as rows, of which all columns are made: what no load uses is left out before.
    stream = add_source(results_stream(spark, path, max_files, archive, whole=True)).select(*USED_COLUMNS, *SOURCE)
    _run(stream.writeStream.foreachBatch(load_batch), checkpoint, every)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOLD_EVERY = 20


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for the queries that start in the block, unless the session names a store itself."""
    own = spark.conf.get(STATE_STORE, None)
    chosen = own is not None and "HDFSBacked" not in own
    if not chosen:
        spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        yield
    finally:
        if not chosen:
            spark.conf.unset(STATE_STORE) if own is None else spark.conf.set(STATE_STORE, own)


def rankings_stream(
    spark: SparkSession,
    path: str,
    sink: str,
    checkpoint: str,
    max_files: int | None = None,
    every: str | None = None,
    fold_every: int = FOLD_EVERY,
) -> DataFrame:
    """Best time and place per swimmer and event, kept up to date as files arrive.

    The state has one row per swimmer and event, however many swims there are, in RocksDB. A batch writes the rows it
    changed to a folder of its own, which a repeated batch writes again; minima merge, so the result is the
    minimum over the folders. Every ``fold_every`` batches these are folded into one, so at most as many are read.
    """
    best = results_stream(spark, path, max_files).groupBy(
        F.col("SwimmerId").alias("swimmer_id"), F.col("Event").alias("event")
    ).agg(F.min(parse_time("Time")).alias("best_time"), F.min(as_int("Overall_Rank")).alias("best_rank"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        if (batch_id + 1) % fold_every == 0:
            fold_rankings(batch.sparkSession, sink, batch_id)

    with _state_on_disk(spark):
        _run(best.writeStream.outputMode("update").foreachBatch(write_batch), checkpoint, every)
    return current_rankings(spark, sink)


def fold_rankings(spark: SparkSession, sink: str, batch_id: int) -> None:
    """Write the minima over all folders to one, then delete the others.

    The new folder has a number that no batch has, and rows are added to it only, so whatever breaks off here, no minimum is
    lost: a row that is there twice does not change one. A reader that began before has to read again.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(sink)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in system.listStatus(folder) if status.getPath().getName().startswith("batch=")]
    into = f"batch={-1 - batch_id}"
    current_rankings(spark, sink).hint("rebalance").write.mode("append").parquet(f"{sink}/{into}")
    for path in found:
        if path.getName() != into:
            system.delete(path, True)


def current_rankings(spark: SparkSession, sink: str) -> DataFrame:
    schema = "swimmer_id string, event string, best_time double, best_rank int, batch bigint"
    return spark.read.schema(schema).parquet(sink).groupBy("swimmer_id", "event").agg(
        F.min("best_time").alias("best_time"), F.min("best_rank").alias("best_rank")
    )
