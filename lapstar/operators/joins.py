"""Equi-joins in which null matches null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal values of ``keys``, null included. The result has the left side's keys once."""
    renamed = {key: f"_right_{key}" for key in keys}
    equal = [F.col(key).eqNullSafe(F.col(name)) for key, name in renamed.items()]
    joined = left.join(right.withColumnsRenamed(renamed), reduce(lambda a, b: a & b, equal), how)
    return joined.drop(*renamed.values())
