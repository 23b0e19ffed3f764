"""Tables in parts, one a load, which are merged in tiers so that their number stays small.

The tables that loads write are partitioned by part. A load is a part of its own until it is merged; a merged part holds the
rows of several loads. One small table says which merged part each merged load is in, and by that alone a part counts or
not: it is replaced as a whole, by a swap, once all parts that it names are written. So readers see the loads before
a merge or after it, never some rows twice or none. The parts that no longer count are dropped by the next merge, which
leaves readers that began before the time in between.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapstar.session import empty, shuffles_dropped
from lapstar.sources.tables import overwrite_swap, read_table

MERGED = "merged_loads"
PREFIX = "merged."
PLACES = "load_id string, part string"
FILE_BYTES, LEAST_BYTES = 32 << 20, 8 << 20

#: How a table's rows of several parts become those of one.
Combine = Callable[[DataFrame], DataFrame]


def check(load_id: str) -> None:
    if load_id.startswith(PREFIX):
        raise ValueError(f"load id {load_id!r}: names that start with {PREFIX!r} are kept for merged loads")


def tier(part: str) -> int:
    """How often the rows of a part were merged."""
    return int(part.removeprefix(PREFIX).split(".")[0]) if part.startswith(PREFIX) else 0


def _new_part(level: int) -> str:
    return f"{PREFIX}{level}.{uuid.uuid4().hex}"


def places(spark: SparkSession, database: str) -> DataFrame:
    """``load_id, part`` of the loads that were merged."""
    found = read_table(spark, f"{database}.{MERGED}")
    return found if found is not None else spark.createDataFrame([], PLACES)


def stored(spark: SparkSession, database: str, names: list[str]) -> list[str]:
    """All parts on disk, also those that do not count."""
    found: set[str] = set()
    for name in names:
        if spark.catalog.tableExists(f"{database}.{name}"):
            found |= {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()}
    return sorted(found)


def _counting(spark: SparkSession, database: str, found: list[str]) -> list[str]:
    loads = [part for part in found if not part.startswith(PREFIX)]
    if not spark.catalog.tableExists(f"{database}.{MERGED}") and len(loads) == len(found):
        return found
    # A row for each merged part, with those of its loads that are on disk too, which the next merge drops.
    inside = F.collect_set(F.when(F.col("load_id").isin(loads), F.col("load_id")))
    rows = places(spark, database).groupBy("part").agg(inside.alias("loads")).collect()
    gone = {load for row in rows for load in row["loads"]}
    counts = {row["part"] for row in rows}
    return [part for part in found if part in counts or (not part.startswith(PREFIX) and part not in gone)]


def live(spark: SparkSession, database: str, names: list[str]) -> list[str]:
    """The parts of some tables that count."""
    return _counting(spark, database, stored(spark, database, names))


def read(spark: SparkSession, database: str, name: str, schema: StructType | None = None) -> tuple[DataFrame | None, int]:
    """A table's rows, and in how many parts they are. Parts are named, so one that is added later is not read."""
    found = read_table(spark, f"{database}.{name}", schema)
    if found is None or "load_id" not in found.columns:
        return found, 0
    parts = live(spark, database, [name])
    return found.filter(F.col("load_id").isin(parts)) if parts else empty(spark, found.schema), len(parts)


def _drop(spark: SparkSession, database: str, names: list[str], parts: list[str]) -> None:
    for name in names:
        if parts and spark.catalog.tableExists(f"{database}.{name}"):
            specs = ", ".join(f"PARTITION (load_id = '{part}')" for part in parts)
            spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS {specs}")


def _packed(rows: DataFrame) -> DataFrame:
    """Stored rows in as few partitions as their files need, or a few more that all cores can work on. They are not shuffled: that
    would cost more than the merge, and rows that lie in the order in which they were written take less place."""
    spark = rows.sparkSession
    jvm, size = spark._jvm, 0
    for folder in sorted({file.rsplit("/", 1)[0] for file in rows.inputFiles()}):  # one a part
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    tasks = min(spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES))
    return rows.coalesce(max(1, tasks, -(-size // FILE_BYTES)))


def _add(rows: DataFrame, combine: Combine, name: str, part: str) -> None:
    """Into a part that does not count yet, so the rows may come from the same table."""
    combined, spark = combine(rows), rows.sparkSession
    columns = [c for c in combined.columns if c != "load_id"]
    chosen = (_packed(rows) if combined is rows else combined).select(*columns)
    with shuffles_dropped(spark):
        spark.sql(f"INSERT INTO {name} PARTITION (load_id = '{part}') ({', '.join(columns)}) SELECT * FROM {{rows}}", rows=chosen)


def _as_they_are(rows: DataFrame) -> DataFrame:
    return rows


def _place(spark: SparkSession, database: str, rows: DataFrame) -> None:
    overwrite_swap(rows.coalesce(1), f"{database}.{MERGED}")


def _full_tier(counting: list[str], fanout: int) -> list[str]:
    """The parts of the lowest tier that has ``fanout`` of them or more. If the part they become fills the next tier, the
    parts of that one as well, and so on: no row is written to a part that is merged at once."""
    tiers = defaultdict(list)
    for part in counting:
        tiers[tier(part)].append(part)
    level = next((k for k in sorted(tiers) if len(tiers[k]) >= fanout), None)
    if level is None:
        return []
    chosen = tiers[level]
    while len(tiers[level + 1]) + 1 >= fanout:
        level += 1
        chosen = chosen + tiers[level]
    return chosen


def due(spark: SparkSession, database: str, names: list[str], fanout: int) -> bool:
    """Whether there is something to merge."""
    found = stored(spark, database, names)
    return len(found) >= fanout and bool(_full_tier(_counting(spark, database, found), fanout))


def merge(spark: SparkSession, database: str, tables: dict[str, Combine], fanout: int) -> int:
    """Merges parts until fewer than ``fanout`` of a tier are left; returns how many merges there were.

    A row is rewritten once a tier, which is the logarithm of the number of loads; there are fewer than ``fanout``
    parts a tier. Only the writer may call this.
    """
    if fanout < 2:
        raise ValueError("merges take two parts at least")
    names, merges = list(tables), 0
    found = stored(spark, database, names)
    counting = _counting(spark, database, found)
    if _full_tier(counting, fanout):
        _drop(spark, database, names, sorted(set(found) - set(counting)))
    while chosen := _full_tier(counting, fanout):
        into = _new_part(max(map(tier, chosen)) + 1)
        for name, combine in tables.items():
            if spark.catalog.tableExists(f"{database}.{name}"):
                rows = spark.read.table(f"{database}.{name}").filter(F.col("load_id").isin(chosen))
                _add(rows, combine, f"{database}.{name}", into)
        known = places(spark, database)
        moved = known.withColumn("part", F.when(F.col("part").isin(chosen), F.lit(into)).otherwise(F.col("part")))
        loads = [(part, into) for part in chosen if not part.startswith(PREFIX)]
        _place(spark, database, moved.unionByName(spark.createDataFrame(loads, PLACES)))
        counting = [part for part in counting if part not in chosen] + [into]
        merges += 1
    return merges


def reopen(spark: SparkSession, database: str, tables: dict[str, Combine], load_ids: list[str], of: str) -> None:
    """Makes parts of their own of loads that were merged, with the rows they brought, so that they can be replaced.

    ``of`` is the table whose rows name their load in ``brought_by``; tables without that column are made anew from its
    rows by their ``Combine``. The rest of the merged part becomes a new one.
    """
    known = places(spark, database)
    hit = known.filter(F.col("load_id").isin(load_ids)).collect()
    if not hit:
        return
    by_part = defaultdict(list)
    for row in hit:
        by_part[row["part"]].append(row["load_id"])
    names, moves = list(tables), {}
    for part, loads in by_part.items():
        _drop(spark, database, names, loads)
        moves[part] = _new_part(tier(part))
        targets = [(moves[part], ~F.col("brought_by").isin(loads)), *[(load, F.col("brought_by") == load) for load in loads]]
        for name, combine in tables.items():
            if not spark.catalog.tableExists(f"{database}.{name}"):
                continue
            own = "brought_by" in spark.read.table(f"{database}.{name}").columns
            rows = spark.read.table(f"{database}.{name if own else of}").filter(F.col("load_id") == part)
            for target, which in targets:
                chosen = rows.filter(which)
                _add(chosen, _as_they_are if own else combine, f"{database}.{name}", target)
    part = F.col("part")
    for old, new in moves.items():
        part = F.when(F.col("part") == old, F.lit(new)).otherwise(part)
    _place(spark, database, known.filter(~F.col("load_id").isin(load_ids)).withColumn("part", part))
