"""Exact row numbers over inputs of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.session import save

# monotonically_increasing_id() keeps the row's position in its low 33 bits, the partition above them.
POSITION_BITS = 33
_POSITION_MASK = (1 << POSITION_BITS) - 1


def number_rows(
    df: DataFrame, order: list[str | Column], name: str, start: int = 0, drop: list[str] | None = None
) -> DataFrame:
    """Add ``name`` = start + 1, start + 2, … in the given order, without one task seeing all rows.

    Columns to ``drop`` only take part in the order: they are not written. The rows are range-partitioned, sorted and written once, each with its partition and position.
    A running sum of the partition sizes, one row per partition, turns the position into the number.
    Writing before counting matters: range bounds come from a sample and may differ between runs.
    """
    kept = save(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .drop(*(drop or [])),
        "numbered",
    )
    partition = F.shiftright("_position", POSITION_BITS)
    sizes = kept.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        F.col("_partition"), (F.sum("_rows").over(before) - F.col("_rows") + F.lit(start)).alias("_offset")
    )
    # At most one row per range partition, so the broadcast is bounded by spark.sql.shuffle.partitions.
    position = F.col("_position").bitwiseAND(F.lit(_POSITION_MASK).cast("bigint"))
    return (
        kept.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select(*[c for c in df.columns if c not in (drop or [])], (F.col("_offset") + position + 1).alias(name))
    )


def highest(df: DataFrame, name: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return df.agg(F.max(name)).first()[0] or 0
