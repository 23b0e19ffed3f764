"""Type 2 history of a dimension, rebuilt as a snapshot.

The rule: after a merge, the current rows of every key in the feed are the feed's rows of that key. Rows that
the feed repeats stay as they are, the others are closed, and new rows start a version. Keys that the feed
does not have stay current. All comparisons treat null as a value, and no join multiplies rows, also when an
id occurs several times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.functions.columns import day
from lapstar.operators.joins import join_null_safe


def current(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def _marked(df: DataFrame, other: DataFrame, columns: list[str], mark: str) -> DataFrame:
    """``df`` with a flag telling whether ``other`` has its values of ``columns``."""
    values = other.select(*columns).distinct().withColumn(mark, F.lit(True))
    return join_null_safe(df, values, columns, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def classify(existing: DataFrame, feed: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Every key as ``same``, ``changed``, ``new`` or ``absent`` from the feed."""
    columns = [key, *attributes]
    now = current(existing).select(*columns)
    fed = _marked(_marked(feed.select(*columns).distinct(), now, columns, "_same"), now, [key], "_known")
    change = F.when(F.col("_same"), "same").when(F.col("_known"), "changed").otherwise("new")
    absent = join_null_safe(now, feed.select(key), [key], "left_anti")
    return fed.select(key, change.alias("change")).unionByName(absent.select(key, F.lit("absent").alias("change")))


def of_keys(existing: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """The rows of the feed's keys: all that decides about closing and new versions.

    For a small feed this is one scan of the dimension with a broadcast, and spares shuffling the rest of it.
    """
    return join_null_safe(existing, feed.select(key), [key], "left_semi")


def _flagged(existing: DataFrame, feed: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """``existing`` with a flag on the rows that a merge closes."""
    flagged = _marked(_marked(existing, feed, [key, *attributes], "_same"), feed, [key], "_known")
    closed = F.col("is_current") & F.col("_known") & ~F.col("_same")
    return flagged.withColumn("_closed", closed).drop("_same", "_known")


def superseded(existing: DataFrame, feed: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """The current rows that a merge closes."""
    return _flagged(existing, feed, key, attributes).filter("_closed").drop("_closed")


def _closing(flagged: DataFrame, columns: list[str], as_of: dt.date | str | None, now: Column | None) -> DataFrame:
    """The rows of ``_flagged`` after the merge."""
    on = day(as_of)
    now = now if now is not None else on.cast("timestamp")
    changes = {"valid_to": F.when(F.col("_closed"), on).otherwise(F.col("valid_to"))}
    if "updated_at" in columns:
        changes["updated_at"] = F.when(F.col("_closed"), now).otherwise(F.col("updated_at"))
    changes["is_current"] = F.col("is_current") & ~F.col("_closed")
    return flagged.withColumns(changes).select(*columns)


def kept(
    existing: DataFrame,
    feed: DataFrame,
    key: str,
    attributes: list[str],
    as_of: dt.date | str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """All old rows, closed where superseded."""
    return _closing(_flagged(existing, feed, key, attributes), existing.columns, as_of, now)


def closed(
    existing: DataFrame,
    feed: DataFrame,
    key: str,
    attributes: list[str],
    as_of: dt.date | str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """The rows that a merge closes, as they are afterwards."""
    over = _flagged(existing, feed, key, attributes).filter("_closed")
    return _closing(over, existing.columns, as_of, now)


def new_versions(
    existing: DataFrame,
    feed: DataFrame,
    key: str,
    attributes: list[str],
    as_of: dt.date | str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Rows of the feed that no current row equals, as the next version of their key."""
    columns = [key, *attributes]
    on = day(as_of)
    now = now if now is not None else on.cast("timestamp")
    held = current(existing).select(*columns)
    versions = existing.groupBy(key).agg(F.max("version").alias("_version"))
    missing = join_null_safe(feed.select(*columns).distinct(), held, columns, "left_anti")
    fresh = join_null_safe(missing, versions, [key], "left")
    values = {
        **{c: F.col(c) for c in columns},
        "is_current": F.lit(True),
        "valid_from": on,
        "version": F.coalesce("_version", F.lit(0)) + 1,
        "created_at": now,
        "updated_at": now,
    }
    return fresh.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in existing.schema]
    )


def merge(
    existing: DataFrame,
    feed: DataFrame,
    key: str,
    attributes: list[str],
    as_of: dt.date | str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """The whole history after the feed."""
    old = kept(existing, feed, key, attributes, as_of, now)
    return old.unionByName(new_versions(existing, feed, key, attributes, as_of, now))
