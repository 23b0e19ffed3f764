"""Type 2 tables that are only appended to: closing a row writes that row, and never the table again.

Next to a table ``t`` lies ``t__closed`` with the rows that are over, as they are since; readers take these in the place
of the rows of ``t`` with the same key. A load's closed rows are appended first, with the highest key that ``t`` then had,
and count once ``t`` has a higher one. So it is the append of the new versions that also closes the old ones: readers see
a history before a load or after it, and what a load leaves that stops in between does not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapstar.operators.keys import highest
from lapstar.sources.tables import OLD, STAGING, append, overwrite_swap, read_table
from lapstar.sources.tables import recover as recover_swap

CLOSED = "__closed"
AFTER = "after_key"


def names(name: str) -> list[str]:
    """The tables that a history is stored in."""
    return [name, name + CLOSED]


def read(spark: SparkSession, name: str, schema: StructType, key: str) -> DataFrame:
    """All rows, each as it is now. Without closed rows this is a scan of the table alone."""
    rows = read_table(spark, name, schema)
    closed = read_table(spark, name + CLOSED)
    if closed is None:
        return rows.select(*schema.names)
    # Closed rows are few next to the table: Spark broadcasts their keys below its threshold.
    closed = closed.filter(F.col(AFTER) < highest(rows, key)).select(*schema.names)
    return rows.join(closed.select(key), key, "left_anti").select(*schema.names).unionByName(closed)


def change(closed: DataFrame, added: DataFrame, name: str, key: str) -> None:
    """Close rows and add others. The frames may not read the tables; keys of added rows are above all others.

    Where nothing is added, the closed rows count at once.
    """
    last, alone = highest(closed.sparkSession.read.table(name), key), added.isEmpty()
    append(closed.withColumn(AFTER, F.lit(last - 1 if alone else last).cast("bigint")), name + CLOSED)
    if not alone:
        append(added, name)


def recover(spark: SparkSession, name: str, key: str) -> None:
    """Undo a swap that broke off, and drop closed rows whose new versions never came. Only the writer may call this."""
    for part in names(name):
        recover_swap(spark, part)
    closed = read_table(spark, name + CLOSED)
    if closed is None or not spark.catalog.tableExists(name):
        return
    last = highest(spark.read.table(name), key)
    if highest(closed, AFTER) >= last:
        overwrite_swap(closed.filter(F.col(AFTER) < last), name + CLOSED)


def fold(spark: SparkSession, name: str, schema: StructType, key: str) -> None:
    """Write the table anew with its closed rows in place. Should this stop before they are dropped, no row differs."""
    overwrite_swap(read(spark, name, schema, key).hint("rebalance"), name)
    spark.sql(f"DROP TABLE IF EXISTS {name + CLOSED}")


def drop(spark: SparkSession, name: str) -> None:
    for part in names(name):
        for each in (part, part + OLD, part + STAGING):
            spark.sql(f"DROP TABLE IF EXISTS {each}")
