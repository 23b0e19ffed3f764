"""Catalog tables: read, append, replace."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lapstar.session import empty, shuffles_dropped

LOG = logging.getLogger(__name__)


STAGING, OLD = "__staging", "__old"


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame | None:
    """A table. A missing one gives an empty frame of ``schema``, or None without a schema.

    If an ``overwrite_swap`` broke off between its renames, the name is missing but the old table is not lost: that
    one is read.
    """
    for found in (name, name + OLD):
        if spark.catalog.tableExists(found):
            spark.catalog.refreshTable(found)  # another session may have written it
            return spark.read.table(found)
    LOG.warning("table %s not found", name)
    return None if schema is None else empty(spark, schema)


def recover(spark: SparkSession, name: str) -> None:
    """Bring a table back to what it was before an ``overwrite_swap`` that broke off, or leave it as that finished.

    Only the writer may call this.
    """
    if spark.catalog.tableExists(name + OLD):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name + OLD}")
        else:
            spark.sql(f"ALTER TABLE {name + OLD} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name + STAGING}")


def append(df: DataFrame, name: str) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").saveAsTable(name)


def overwrite_swap(df: DataFrame, name: str) -> None:
    """Replace a table; ``df`` may read the table it replaces.

    The rows go to a staging table first. Then the names are exchanged, and put back should that fail, so the
    old table stays whole until the new one is. Wherever this stops, one whole table is left, which ``read_table``
    finds and ``recover`` gives its name back. Frames of the old table must be read again afterwards.
    """
    spark = df.sparkSession
    staging, old = name + STAGING, name + OLD
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    with shuffles_dropped(spark):
        df.write.saveAsTable(staging)
    existed = spark.catalog.tableExists(name)
    if existed:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if existed:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def replace_load(df: DataFrame, name: str, load_id: str) -> None:
    """Write the rows of one load into a table partitioned by ``load_id``; a repeated load replaces itself."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"load id {load_id!r}: use letters, digits, '_', '.' and '-'")
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}, load_id string) USING parquet PARTITIONED BY (load_id)")
    names = ", ".join(df.columns)
    with shuffles_dropped(spark):
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION (load_id = '{load_id}') SELECT {names} FROM {{rows}}", rows=df
        )
