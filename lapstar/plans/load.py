"""The whole load: raw results → dimensions → facts, kept in the tables of one database."""

from __future__ import annotations

import datetime as dt
import threading
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapstar.operators import dims, facts, quality
from lapstar.operators.facts import merge_rankings
from lapstar.operators.keys import highest
from lapstar.schemas import (
    DIM_COMPETITION,
    DIM_EVENT,
    DIM_SWIMMER,
    FACT_PERFORMANCE,
    FACT_RANKINGS,
    RAW_COLUMNS,
    RAW_WITH_SOURCE,
    SOURCE,
    USED_COLUMNS,
    Warehouse,
)
from lapstar.session import empty, new_path, save, scratch
from lapstar.sources import history, parts
from lapstar.sources.files import read_by_name, read_results, results_glob
from lapstar.sources.lock import writer
from lapstar.sources.tables import OLD, STAGING, append, overwrite_swap, read_table, recover, replace_load

TABLES = {
    "dim_swimmer": DIM_SWIMMER,
    "dim_event": DIM_EVENT,
    "dim_competition": DIM_COMPETITION,
    "fact_swimming_performance": FACT_PERFORMANCE,
    "fact_rankings": FACT_RANKINGS,
}

# The ranges of keys that loads have taken, in the place of sequences; the ids of ranked pairs; the loads in the order
# in which they first came; and the files they have read.
KEYS, PAIRS, LOADS, FILES = "load_keys", "ranking_ids", "loads", "loaded_files"
PAIR_IDS = FACT_RANKINGS.fieldNames()[:3]
SWIMMER_KEY = "swimmer_sk"

# Names the load of a row where several are merged into one part.
BROUGHT_BY = "brought_by"
FANOUT = 10
# A table that is appended to is written anew from so many files on, and two more for each full file it has.
MANY_FILES, FILE_BYTES = 32, 128 << 20

_WRITERS: dict[str, threading.Lock] = defaultdict(threading.Lock)


@contextmanager
def _writing(spark: SparkSession, database: str) -> Iterator[None]:
    """One writer at a time: threads of one session by a lock in the process, sessions by one in the file system."""
    with _WRITERS[database]:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        with writer(spark, spark.catalog.getDatabase(database).locationUri):
            yield


def _rankings(spark: SparkSession, database: str) -> DataFrame:
    rows, count = parts.read(spark, database, "fact_rankings", FACT_RANKINGS)
    # A single part has one row per swimmer and event already.
    return merge_rankings(rows) if count > 1 else rows


def read_warehouse(spark: SparkSession, database: str) -> Warehouse:
    frames = {name: read_table(spark, f"{database}.{name}", TABLES[name]) for name in ("dim_event", "dim_competition")}
    frames["dim_swimmer"] = history.read(spark, f"{database}.dim_swimmer", DIM_SWIMMER, SWIMMER_KEY)
    frames["fact_swimming_performance"], _ = parts.read(spark, database, "fact_swimming_performance", FACT_PERFORMANCE)
    frames["fact_rankings"] = _rankings(spark, database)
    return Warehouse(*[frames[name].select(*schema.names) for name, schema in TABLES.items()])


def _add(rows: DataFrame, name: str) -> None:
    """Append, unless that would only add an empty file to a table: small batches mostly bring nothing new."""
    if not rows.sparkSession.catalog.tableExists(name) or not rows.isEmpty():
        append(rows, name)


def _apply(change: dims.Change, name: str) -> None:
    if change.rewrites and change.closed is not None:
        history.change(change.closed, change.added, name, SWIMMER_KEY)
    elif change.rewrites:
        overwrite_swap(change.whole(), name)
    else:
        _add(change.added, name)


def _recover(spark: SparkSession, database: str) -> None:
    """Undo a swap that broke off, and refuse to go on if a dimension of stored facts is gone."""
    for name in [*TABLES, KEYS, PAIRS, LOADS, parts.MERGED]:
        recover(spark, f"{database}.{name}")
    history.recover(spark, f"{database}.dim_swimmer", SWIMMER_KEY)
    stored = {name: spark.catalog.tableExists(f"{database}.{name}") for name in TABLES}
    lost = [name for name in TABLES if name.startswith("dim_") and not stored[name]]
    if lost and stored["fact_swimming_performance"]:
        raise RuntimeError(f"{database} has facts but not {', '.join(lost)}: new keys would name other rows")


def _known_load(spark: SparkSession, database: str, load_id: str) -> bool:
    """Note the load; whether it is an older one that comes again, after others."""
    known = read_table(spark, f"{database}.{LOADS}")
    number, last = 1, 0
    if known is not None:
        first = known.agg(F.min(F.when(F.col("load_id") == load_id, F.col("number"))), F.max("number")).first()
        if first[0] is not None:
            return first[0] < first[1]
        last = first[1] or 0
    noted = spark.createDataFrame([(load_id, last + number)], "load_id string, number bigint")
    append(noted.coalesce(1), f"{database}.{LOADS}")
    return False


def _take_keys(spark: SparkSession, database: str, load_id: str, rows: int) -> int:
    """Number before the first key of a load of so many swims; the keys up to the last are then its own.

    A load that comes again gets the same keys if they are enough, else a new range behind all others.
    """
    first, last, most = None, 0, 0
    stored = read_table(spark, f"{database}.{KEYS}")
    if stored is not None:
        # The newest of its ranges: each one is behind all those before.
        own = F.when(F.col("load_id") == load_id, F.struct("first_key", "last_key"))
        row = stored.agg(F.max(own).alias("own"), F.max("last_key").alias("most")).first()
        most = row["most"] or 0
        if row["own"] is not None:
            first, last = row["own"]
    if first is None or first + rows > last:
        first, last = most, most + rows
        taken = spark.createDataFrame([(load_id, first, last)], "load_id string, first_key bigint, last_key bigint")
        append(taken.coalesce(1), f"{database}.{KEYS}")
    return first


def run_load(
    spark: SparkSession,
    raw: DataFrame,
    database: str,
    load_id: str,
    as_of: dt.date | str | None = None,
    tie: list[str] | None = None,
) -> Warehouse:
    """Add raw results to the warehouse and return it as it is afterwards.

    Keys of known rows never change. Facts are stored per ``load_id``, where a load replaces its own, under the same
    ids; so a load that stopped half-way is simply run again. If other loads came since, its swimmers and competitions
    are older than what the dimensions have: only those that are unknown are added, and swims keep their versions.
    A warehouse has one writer: loads wait for each other, also those of other sessions and applications.
    ``raw`` is read once for the swimmers, once for the other dimensions and once for the swims: pass a table,
    as ``load_files`` does.
    """
    parts.check(load_id)
    with _writing(spark, database), scratch(spark):
        _recover(spark, database)
        _reopen(spark, database, [load_id])
        older = _known_load(spark, database, load_id)
        feed = dims.swimmer_feed(raw)
        _load_dimensions(spark, feed, dims.programme(raw), database, as_of, older)
        _load_facts(spark, raw, database, load_id, tie, feed, older)
    return read_warehouse(spark, database)


def _load_dimensions(
    spark: SparkSession, feed: DataFrame, programme: DataFrame, database: str, as_of: dt.date | str | None, older: bool
) -> None:
    known = read_warehouse(spark, database)
    if older:
        feed = dims.unknown_swimmers(feed, known.swimmers)
    steps = [
        lambda: _apply(dims.swimmers(feed, as_of, known.swimmers), f"{database}.dim_swimmer"),
        lambda: _apply(dims.events(programme, known.events), f"{database}.dim_event"),
        lambda: _apply(dims.competitions(programme, known.competitions, not older), f"{database}.dim_competition"),
    ]
    # The dimensions do not depend on each other: their jobs share the cluster.
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(copy_context().run, step) for step in steps]:
            done.result()


def _load_facts(
    spark: SparkSession, raw: DataFrame, database: str, load_id: str, tie: list[str] | None, feed: DataFrame, older: bool
) -> None:
    loaded = read_warehouse(spark, database)
    # Shared ids are told apart by the attributes. Where the feed has none, an id alone also tells which version the swims of
    # an older load keep.
    by_attributes = not quality.duplicates(feed, ["swimmer_id"], allow_null=True).isEmpty()
    swims = facts.numbered_swims(raw, tie, by_attributes)
    start = _take_keys(spark, database, load_id, swims.count())
    swims = swims.withColumn("performance_id", F.col("performance_id") + start)
    if older:
        held = save(dims.versions_of(feed, loaded.swimmers), "versions")
        rows = facts.of_versions(swims, held, loaded.events, loaded.competitions, by_attributes)
    else:
        rows = facts.resolved(swims, loaded.swimmers, loaded.events, loaded.competitions, by_attributes)
    if SOURCE[0] not in rows.columns:
        rows = rows.withColumn(SOURCE[0], F.lit(None).cast("string"))
    rows = rows.withColumn(BROUGHT_BY, F.lit(load_id))
    replace_load(rows, f"{database}.fact_swimming_performance", load_id)
    _load_rankings(spark, database, load_id)


def _load_rankings(spark: SparkSession, database: str, load_id: str) -> None:
    """The ranking rows of a load, from its swims as they are stored."""
    added = spark.read.table(f"{database}.fact_swimming_performance").filter(F.col("load_id") == load_id)
    pairs, schema = f"{database}.{PAIRS}", StructType([FACT_RANKINGS[name] for name in PAIR_IDS])
    ids = read_table(spark, pairs, schema)
    start = highest(ids, "ranking_id")
    found = facts.with_ids(facts.best_results(added), ids)
    fresh = facts.new_rankings(found, start)
    _add(fresh.select(*PAIR_IDS), pairs)
    replace_load(facts.known_rankings(found).unionByName(fresh), f"{database}.fact_rankings", load_id)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The results files of a folder as ``file, size, modified, source_file, unit``; their content is not read.

    ``source_file`` is the name under which rows know their file. ``unit`` is the results file, which is the file itself or
    the folder of its parts.
    """
    try:
        found = spark.read.format("binaryFile").load(results_glob(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no result files in {path}") from error
        raise
    return found.select(
        F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        F.col("_metadata.file_path").alias(SOURCE[0]),
        F.regexp_extract("path", r"^(.*_results\.csv)(/.*)?$", 1).alias("unit"),
    )


def _outdated(files: DataFrame, new: DataFrame, others: DataFrame) -> DataFrame:
    """``source_file, load_id`` of what other loads have of files that came again, or that are gone from a unit with new parts."""
    again = others.join(new.select("file").distinct(), "file", "left_semi")
    gone = others.join(new.select("unit").distinct(), "unit", "left_semi").join(files.select("file"), "file", "left_anti")
    return again.unionByName(gone).select(SOURCE[0], F.col(BROUGHT_BY).alias("load_id")).distinct()


def _retire(spark: SparkSession, database: str, outdated: DataFrame) -> None:
    """Takes the swims of older versions of files from the loads that brought them, and ranks those loads anew."""
    name = f"{database}.fact_swimming_performance"
    loads = [row["load_id"] for row in outdated.select("load_id").distinct().collect()]
    if not loads:
        return
    files = outdated.select(SOURCE[0]).distinct()
    with _writing(spark, database), scratch(spark):
        stored, _ = parts.read(spark, database, "fact_swimming_performance")
        stored = stored.filter(F.col(BROUGHT_BY).isin(loads))
        hit = stored.join(files, SOURCE[0], "left_semi").select(BROUGHT_BY).distinct().collect()
        hit = sorted(row[BROUGHT_BY] for row in hit)
        _reopen(spark, database, hit)
        for load_id in hit:
            swims = spark.read.table(name).filter(F.col("load_id") == load_id)
            rest = swims.join(files, SOURCE[0], "left_anti").drop("load_id")
            replace_load(save(rest.select(*FACT_PERFORMANCE.names, SOURCE[0], BROUGHT_BY), "rest"), name, load_id)
            _load_rankings(spark, database, load_id)


def _in_parts(spark: SparkSession, database: str) -> dict[str, parts.Combine]:
    """The tables that are stored in parts, and how parts of them become one."""

    def ranked(rows: DataFrame) -> DataFrame:
        if "ranking_id" in rows.columns:
            return merge_rankings(rows).select(*FACT_RANKINGS.names)
        return facts.load_rankings(facts.best_results(rows), spark.read.table(f"{database}.{PAIRS}"))

    return {"fact_swimming_performance": _as_they_are, "fact_rankings": ranked, FILES: _as_they_are}


def _as_they_are(rows: DataFrame) -> DataFrame:
    return rows


def _reopen(spark: SparkSession, database: str, load_ids: list[str]) -> None:
    """Loads that are to be replaced, as parts of their own. Costs a rewrite of the merged parts they are in."""
    if load_ids and spark.catalog.tableExists(f"{database}.{parts.MERGED}"):
        parts.reopen(spark, database, _in_parts(spark, database), load_ids, "fact_swimming_performance")


def _many_files(spark: SparkSession, name: str) -> bool:
    """Whether a table has many appended files, the more the larger it is."""
    if not spark.catalog.tableExists(name):
        return False
    files = spark.read.table(name).inputFiles()
    if len(files) < MANY_FILES:
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return len(files) >= MANY_FILES + 2 * size // FILE_BYTES


def _fold(spark: SparkSession, database: str) -> None:
    """Write tables anew that have many files."""
    for name in ["dim_event", "dim_competition", KEYS, PAIRS, LOADS]:
        if _many_files(spark, f"{database}.{name}"):
            overwrite_swap(spark.read.table(f"{database}.{name}").hint("rebalance"), f"{database}.{name}")
    swimmers = f"{database}.dim_swimmer"
    if any(_many_files(spark, name) for name in history.names(swimmers)):
        history.fold(spark, swimmers, DIM_SWIMMER, SWIMMER_KEY)


def compact(spark: SparkSession, database: str, fanout: int = FANOUT) -> int:
    """Merge closed loads and small files; returns the number of merges. Reports do not change.

    From ``fanout`` loads on, their facts become one part, from ``fanout`` of these on those become one, and so on: a swim
    is rewritten as often as the number of loads has digits, and reports read fewer than ``fanout`` parts per digit.
    A merged load can still be replaced, and its files corrected; that takes it out of its part first, which rewrites it.
    Readers that began before see the loads as they were, until the merge after this one.
    """
    tables = _in_parts(spark, database)
    if not parts.due(spark, database, list(tables), fanout):
        return 0
    with _writing(spark, database), scratch(spark):
        _recover(spark, database)
        merges = parts.merge(spark, database, tables, fanout)
        _fold(spark, database)
    return merges


def _noted(files: DataFrame, load_id: str, done: bool) -> DataFrame:
    return files.withColumns({"done": F.lit(done), BROUGHT_BY: F.lit(load_id)})


# Of the columns that no load uses, only which of them are null is kept for the profile: a bit each.
UNUSED_COLUMNS = [name for name in RAW_COLUMNS if name not in USED_COLUMNS]
NULLS = "null_bits"


def _staged(new: DataFrame) -> DataFrame:
    """The rows of files as they are stored for a load and its profile."""
    bits = [F.when(F.col(name).isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, name in enumerate(UNUSED_COLUMNS)]
    return new.select(*USED_COLUMNS, *SOURCE, reduce(lambda a, b: a.bitwiseOR(b), bits).alias(NULLS))


def _profile(staged: DataFrame) -> DataFrame:
    """The profile of each file, from what ``_staged`` keeps."""
    unused = {name: F.when(F.col(NULLS).bitwiseAND(F.lit(1 << k)) == 0, "") for k, name in enumerate(UNUSED_COLUMNS)}
    return quality.profile(staged.withColumns(unused), "source_file", RAW_COLUMNS)


def load_files(
    spark: SparkSession,
    path: str,
    database: str,
    load_id: str,
    as_of: dt.date | str | None = None,
    by_name: bool = False,
) -> tuple[Warehouse, DataFrame]:
    """The whole job on the new files of a folder: the warehouse after the load, and a profile of each file.

    New are files that no other load has read, by path, size and time of the last change; the load's own are read again
    if it is repeated. A file that came again with other content replaces what its older versions brought, whichever load
    did; so do new parts of a results file for parts that are gone. A results file that is gone as a whole keeps its swims.
    The text is parsed once, into a Parquet table of what the profile and the load read. With ``by_name`` the
    files' columns are found by their headers, in any order.
    """
    parts.check(load_id)
    kept = new_path(spark, "profile")
    with scratch(spark):
        found = save(_files(spark, path), "found")
        log, _ = parts.read(spark, database, FILES)
        files, outdated = found, None
        if log is not None:
            others = save(log.filter(F.col(BROUGHT_BY) != load_id), "others")
            known = ["file", "size", "modified"]
            files = save(found.join(others.filter("done"), known, "left_anti"), "files")
            outdated = save(_outdated(found, files, others), "outdated")
        # Spark lists the files on the driver in any case; only the new ones are opened.
        paths = [row["file"] for row in files.select("file").collect()]
        read = read_by_name if by_name else read_results
        new = read(spark, paths, with_source=True) if paths else empty(spark, RAW_WITH_SOURCE)
        staged = save(_staged(new), "staged")
        profile, raw = save(_profile(staged), path=kept), staged.drop(NULLS)
        if not paths:
            return read_warehouse(spark, database), profile
        # Noted before and after, so that what a load that breaks off has brought is found by the next one.
        with _writing(spark, database):
            _reopen(spark, database, [load_id])
            replace_load(_noted(files, load_id, False), f"{database}.{FILES}", load_id)
        run_load(spark, raw, database, load_id, as_of)
        if outdated is not None:
            _retire(spark, database, outdated)
        with _writing(spark, database):
            _reopen(spark, database, [load_id])  # another writer may have merged it
            replace_load(_noted(files, load_id, True), f"{database}.{FILES}", load_id)
        return read_warehouse(spark, database), profile


def row_counts(warehouse: Warehouse) -> DataFrame:
    """Rows of each table."""
    frames = [
        warehouse.swimmers, warehouse.events, warehouse.competitions, warehouse.performance, warehouse.rankings,
    ]
    counts = None
    for name, frame in zip(TABLES, frames):
        one = frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def reset(spark: SparkSession, database: str) -> None:
    """Drop the tables, facts before the dimensions they point to."""
    for name in [*reversed(TABLES), KEYS, PAIRS, LOADS, FILES, parts.MERGED]:
        for part in (name, name + OLD, name + STAGING):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{part}")
    history.drop(spark, f"{database}.dim_swimmer")
