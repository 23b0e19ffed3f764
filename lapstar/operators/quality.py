"""Profiling, and the constraints of the star schema as jobs that return the violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def describe_columns(df: DataFrame) -> DataFrame:
    """Names and types of the columns, in order."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, column_type string")


def profile(raw: DataFrame, by: Column | str, columns: list[str] | None = None) -> DataFrame:
    """Rows and nulls of each column per group, such as per input file, in one pass over all files."""
    columns = columns if columns is not None else raw.columns
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c.lower()}") for c in columns]
    return raw.groupBy(by).agg(F.count("*").alias("rows"), *nulls)


def _long(counts: DataFrame, value: str) -> DataFrame:
    """One row of named counts as (column_name, value) rows."""
    return counts.unpivot([], counts.columns, "column_name", value)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "nulls")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Texts above their length limit, counted per column."""
    counts = [F.count_if(F.length(c) > limit).alias(c) for c, limit in limits.items()]
    return _long(df.agg(*counts), "violations")


def duplicates(df: DataFrame, keys: list[str], allow_null: bool = False) -> DataFrame:
    """Keys that occur more than once.

    A primary key may not be null, so null keys count as violations. In a unique constraint nulls never
    equal each other, so with ``allow_null`` keys that hold a null are left out.
    """
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    if allow_null:
        df = df.filter(~has_null)
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.filter((F.col("n") > 1) | has_null)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys that the dimension does not have, with their number of rows.

    The fact is counted per key before the join, so a key with many rows is one row in the shuffle.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return used.join(dim.select(key), key, "left_anti")
