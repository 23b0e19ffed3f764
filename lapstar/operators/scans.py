"""Ordered work inside groups of any size, with one shuffle of the rows.

A window function gives each group to one task. So groups with more rows than a shuffle partition should have are cut into
blocks of consecutive rows: a sample of such a group, taken by a hash of the rows' order, gives the borders between its blocks. All
rows are then shuffled once, by group and block, and windows run inside blocks; a block of a cut group also gets from
the blocks before it what it needs: their number of rows, their minimum, their last values. There are at most twice as
many blocks of cut groups as shuffle partitions, so borders and what blocks pass on are small tables of a known bound.

Which groups are large is told by the counts of ``BUCKETS`` hashes of the keys: a group has no more rows than its bucket, so
only groups of buckets above the size are counted one by one. There are more partitions than the session asks for where
tasks would get more than ``TASK_ROWS`` rows and sort on disk.

Orders are lists of columns, ascending and nulls first; ``nulls_last`` puts nulls behind. Rows of a group that are equal in the
whole order stay in one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from lapstar.operators.joins import join_null_safe
from lapstar.session import save, tasks_for

BLOCK = "_block"
SAMPLES = 32  # of each block
BUCKETS = 1 << 16


def nulls_last(name: str) -> list[Column | str]:
    """The items of an order by a column, nulls last."""
    return [F.col(name).isNull(), name]


def _place(order: list[Column | str]) -> Column:
    items = [F.col(x) if isinstance(x, str) else x for x in order]
    return F.struct(*[x.alias(f"o{i}") for i, x in enumerate(items)])


def _large(df: DataFrame, keys: list[str], counts: DataFrame, size: int) -> DataFrame:
    """``keys, _rows`` of the groups with more than ``size`` rows, fewer than partitions, from the counts of buckets."""
    full = counts.filter(F.col("_rows") > size).select("_bucket")
    rows = df.select(*keys, _bucket(keys)).join(F.broadcast(full), "_bucket", "left_semi")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return save(sizes.filter(F.col("_rows") > size), "large")


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")


def _borders(df: DataFrame, keys: list[str], order: list[Column | str]) -> tuple[DataFrame | None, int]:
    """``keys, _borders``: for each group that is too large for a partition, where its blocks after the first begin. And
    the number of rows."""
    counts = save(df.groupBy(_bucket(keys)).agg(F.count("*").alias("_rows")), "buckets")
    total, most = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.max("_rows")).first()
    size = -(-total // tasks_for(df.sparkSession, total)[0])
    if not total or most <= size:
        return None, total
    large = _large(df, keys, counts, size)
    if large.isEmpty():
        return None, total
    place = _place(order).alias("_place")
    rows = join_null_safe(df.select(*keys, place), F.broadcast(large), keys)
    sample = rows.filter(F.pmod(F.xxhash64("_place"), F.lit(max(1, size // SAMPLES))) == 0)
    blocks = F.ceil(F.col("_rows") / size).cast("int")
    found = sample.groupBy(*keys, "_rows").agg(F.sort_array(F.collect_list("_place")).alias("_sample"))
    at = F.sequence(F.lit(1), F.least(blocks - 1, F.size("_sample")))
    picked = F.transform(at, lambda i: F.get("_sample", (i * F.size("_sample") / blocks).cast("int")))
    return save(found.select(*keys, F.array_distinct(picked).alias("_borders")), "borders"), total


def _cut(df: DataFrame, keys: list[str], order: list[Column | str]) -> tuple[DataFrame, bool, int]:
    """The rows with their block, whether any group has several, and the number of rows. ``_large`` marks rows of groups
    that have."""
    borders, total = _borders(df, keys, order)
    if borders is None:
        return df.withColumn(BLOCK, F.lit(0)).withColumn("_large", F.lit(False)), False, total
    rows = join_null_safe(df, F.broadcast(borders), keys, "left").withColumn("_place", _place(order))
    before = F.size(F.filter("_borders", lambda border: border <= F.col("_place")))
    rows = rows.withColumn(BLOCK, F.when(F.col("_borders").isNull(), 0).otherwise(before))
    return rows.withColumn("_large", F.col("_borders").isNotNull()).drop("_borders", "_place"), True, total


def blocks(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The rows with the number of their block inside their group."""
    return _cut(df, keys, order)[0].drop("_large")


def _dealt(rows: DataFrame, keys: list[str], several: bool, total: int) -> DataFrame:
    """The rows shuffled by group and block, as the windows need them, where they are too many to leave that to Spark."""
    tasks, insist = tasks_for(rows.sparkSession, total)
    # Spark drops a constant block from the windows' keys and would shuffle again if the rows were dealt by it.
    return rows.repartition(tasks, *keys, *([BLOCK] if several else [])) if insist else rows


def _in_block(keys: list[str], order: list[Column | str]) -> WindowSpec:
    rows = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    return rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _handed_on(rows: DataFrame, keys: list[str], passed: DataFrame) -> DataFrame:
    """Each row with what its block gets: one row of ``passed`` per block of a cut group. Joined behind the windows, it is
    neither shuffled nor sorted with the rows."""
    return join_null_safe(rows, F.broadcast(save(passed, "passed")), [*keys, BLOCK], "left")


def number_in_groups(df: DataFrame, keys: list[str], order: list[Column | str], name: str) -> DataFrame:
    """``row_number`` within groups."""
    rows, several, total = _cut(df, keys, order)
    number = F.row_number().over(_in_block(keys, order)).cast("bigint")
    numbered = _dealt(rows, keys, several, total).withColumn(name, number)
    if several:
        each = rows.filter("_large").groupBy(*keys, BLOCK).agg(F.count("*").alias("_size"))
        before = each.select(*keys, BLOCK, F.sum("_size").over(_earlier(keys)).alias("_before"))
        numbered = _handed_on(numbered, keys, before).withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
    return numbered.select(*df.columns, name)


def _least_before(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``_least`` for each block of a cut group: the minimum before it."""
    each = rows.filter("_large").groupBy(*keys, BLOCK).agg(F.min(value).alias("_own"))
    return each.select(*keys, BLOCK, F.min("_own").over(_earlier(keys)).alias("_least"))


def _with_minimum(
    dealt: DataFrame, before: DataFrame | None, keys: list[str], order: list[Column | str], value: str, name: str
) -> DataFrame:
    dealt = dealt.withColumn(name, F.min(value).over(_in_block(keys, order)))
    return dealt if before is None else _handed_on(dealt, keys, before).withColumn(name, F.least("_least", name))


def _last_values(rows: DataFrame, keys: list[str], order: list[Column | str], value: str, length: int) -> DataFrame:
    """``_halo`` for each block of a cut group: the last ``length`` values before it, oldest first."""
    place = _place(order).alias("_place")
    rows = rows.filter("_large").select(*keys, BLOCK, F.col(value).alias("_value"), place)
    newest = Window.partitionBy(*keys, BLOCK).orderBy(F.desc("_place"))
    last = rows.filter("_value is not null").withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= length)
    oldest_first = F.reverse(F.array_sort(F.collect_list(F.struct("_age", "_value"))))
    own = last.groupBy(*keys, BLOCK).agg(F.transform(oldest_first, lambda x: x["_value"]).alias("_values"))
    # Blocks without values have nothing to pass on: the last ``length`` of the others hold enough.
    recent = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(1 - length, Window.currentRow)
    upto = own.withColumn("_upto", F.flatten(F.collect_list("_values").over(recent)))
    upto = upto.select(*keys, BLOCK, F.slice("_upto", F.greatest(F.size("_upto") - length + 1, F.lit(1)), length).alias("_upto"))
    every = join_null_safe(rows.select(*keys, BLOCK).distinct(), upto, [*keys, BLOCK], "left")
    return every.select(*keys, BLOCK, F.last("_upto", ignorenulls=True).over(_earlier(keys)).alias("_halo"))


def _with_lists(
    dealt: DataFrame, before: DataFrame | None, keys: list[str], order: list[Column | str], value: str, length: int, name: str
) -> DataFrame:
    # Null values take no slot: the frame counts values (_v), not rows.
    dealt = dealt.withColumn("_v", F.count(value).over(_in_block(keys, order)))
    window = Window.partitionBy(*keys, BLOCK).orderBy("_v").rangeBetween(1 - length, Window.currentRow)
    # The values of equal numbers: one, and rows without a value.
    dealt = dealt.withColumn("_own", F.collect_list(value).over(window))
    if before is None:
        return dealt.withColumn(name, F.col("_own"))
    dealt = _handed_on(dealt, keys, before)
    whole = F.concat("_halo", "_own")
    whole = F.slice(whole, F.greatest(F.size(whole) - length + 1, F.lit(1)), length)
    short = F.col("_halo").isNotNull() & (F.size("_own") < length)
    return dealt.withColumn(name, F.when(short, whole).otherwise(F.col("_own")))


def running_min(df: DataFrame, keys: list[str], order: list[Column | str], value: str, name: str) -> DataFrame:
    """Smallest non-null ``value`` of the group up to and including each row."""
    rows, several, total = _cut(df, keys, order)
    before = _least_before(rows, keys, value) if several else None
    return _with_minimum(_dealt(rows, keys, several, total), before, keys, order, value, name).select(*df.columns, name)


def trailing_list(
    df: DataFrame, keys: list[str], order: list[Column | str], value: str, length: int, name: str
) -> DataFrame:
    """The last ``length`` non-null values of the group up to and including each row, oldest first."""
    rows, several, total = _cut(df, keys, order)
    before = _last_values(rows, keys, order, value, length) if several else None
    return _with_lists(_dealt(rows, keys, several, total), before, keys, order, value, length, name).select(*df.columns, name)


def running_min_and_list(
    df: DataFrame, keys: list[str], order: list[Column | str], value: str, length: int, least: str, last: str
) -> DataFrame:
    """``running_min`` and ``trailing_list`` from one shuffle of the rows."""
    rows, several, total = _cut(df, keys, order)
    minimum = _least_before(rows, keys, value) if several else None
    lists = _last_values(rows, keys, order, value, length) if several else None
    dealt = _with_minimum(_dealt(rows, keys, several, total), minimum, keys, order, value, least)
    return _with_lists(dealt, lists, keys, order, value, length, last).select(*df.columns, least, last)
