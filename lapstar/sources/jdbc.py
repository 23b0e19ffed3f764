"""Tables of a relational database, for users who keep the star schema there."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LOG = logging.getLogger(__name__)

# SQL states with which databases report a table that does not exist.
NO_SUCH_TABLE = {"42P01", "42S02", "42X05", "S0002"}


def _sql_state(error: Py4JJavaError) -> str | None:
    cause = error.java_exception
    while cause is not None:
        if "SQL" in cause.getClass().getSimpleName():
            return cause.getSQLState()
        cause = cause.getCause()
    return None


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame | None:
    """A table, or None with a warning when it does not exist. Other failures, as of the connection, are raised.

    With a numeric ``column`` and its ``bounds`` the read is split into ``partitions`` parallel queries;
    rows outside the bounds are read as well.
    """
    split = {}
    if column is not None and bounds is not None:
        split = {"column": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions}
    try:
        return spark.read.jdbc(url, table, properties=properties or {}, **split)
    except Py4JJavaError as error:
        if _sql_state(error) not in NO_SUCH_TABLE:
            raise
        LOG.warning("table %s not found", table)
        return None


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None
) -> None:
    """Append to, or replace the rows of, a table. Replacing keeps the table's keys and constraints."""
    keep = {"truncate": "true"} if mode == "overwrite" else {}
    df.write.jdbc(url, table, mode=mode, properties={**keep, **(properties or {})})
