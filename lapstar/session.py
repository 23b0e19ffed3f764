"""Session settings, and tables written to the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A one-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lapstar")
    settings = {"spark.driver.memory": memory, **LOCAL_CONF, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    A session in one process without the setting gets a temporary folder. On a cluster, also a simulated one, the
    setting is required: a folder of one machine would lose its files with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lapstar-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/lapstar-{context.applicationId}"


# The folder of the innermost scratch() block of this thread.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_SCRATCH.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables saved inside the block are deleted at its end, so store what is needed of them elsewhere.

    Threads started in the block belong to it if they run in a copy of its context.
    """
    folder = new_path(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Spark keeps the files of a shuffle until the driver happens to collect its garbage, unless this is set when a job starts.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: Counter[str] = Counter()
_BEFORE: dict[str, str | None] = {}
_DROPPING_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write in the block go as soon as it is done. What is written is read again, not made again, so
    nothing misses them. Threads that share the session may be in such blocks at the same time."""
    session = str(spark._jsparkSession.sessionUUID())
    with _DROPPING_LOCK:
        if not _DROPPING[session]:
            _BEFORE[session] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _DROPPING[session] += 1
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            _DROPPING[session] -= 1
            if not _DROPPING[session]:
                del _DROPPING[session]
                before = _BEFORE.pop(session)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def save(df: DataFrame, label: str = "rows", path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of one task of a shuffle at most: sorts of so many, also of some hundred bytes each, stay in an executor's memory.
TASK_ROWS = 250_000


def tasks_for(spark: SparkSession, rows: int) -> tuple[int, bool]:
    """Partitions that a shuffle of ``rows`` needs, and whether to insist on them: Spark merges small ones to some of 64 MB as
    they are shuffled, which is right for few rows only, since it may be several times more where they are sorted."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    return tasks, rows > 4 * TASK_ROWS


@contextmanager
def shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside the block shuffle into as many partitions as ``rows`` need."""
    tasks, insist = tasks_for(spark, rows)
    wanted = {"spark.sql.shuffle.partitions": str(tasks)}
    if insist:
        wanted["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and known to have none when a plan is optimised: joins with it fall away."""
    return spark.createDataFrame([], schema).where("false")
