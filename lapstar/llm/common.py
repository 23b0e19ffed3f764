"""Shared helpers: text columns as byte buffers, and whole-batch functions over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
STRING_ROWS = 500


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python 2,000 rows at a time, unless the session says otherwise: Spark's 10,000 take 40 MB and more,
    several times over, in each task."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text``; a null text is empty. All other columns are left out."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    data = column.buffers()[2]
    found = np.frombuffer(data, np.uint8, last - first, first) if data is not None and last > first else None
    return (np.zeros(0, np.uint8) if found is None else found), offsets - first


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` bytes; a longer text is a run of its own."""
    begin, n = 0, len(offsets) - 1
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
        end = min(n, max(end, begin + 1))
        yield begin, end
        begin = end


def map_texts(
    df: DataFrame, function: Callable[..., dict[str, object]], schema: str,
    text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False,
) -> DataFrame:
    """One output row per text: ``function(bytes, offsets)`` gives the new columns for a run of texts.

    With ``with_ids`` it also gets the first column of ``keep``.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            data, offsets = utf8(batch.column(text_col))
            for begin, end in slices(offsets):
                part = offsets[begin : end + 1]
                kept = {name: batch.column(name).slice(begin, end - begin) for name in keep}
                ids = (kept[keep[0]],) if with_ids else ()
                made = function(data[part[0] : part[-1]], part - part[0], *ids)
                yield pa.RecordBatch.from_pydict({**kept, **made})

    return df.mapInArrow(batches, schema)


def map_strings(
    df: DataFrame, function: Callable[[list[str]], dict[str, list]], schema: str,
    text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """As ``map_texts``, for functions of Python strings."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for begin in range(0, len(batch), STRING_ROWS):
                part = batch.slice(begin, STRING_ROWS)
                kept = {name: part.column(name) for name in keep}
                yield pa.RecordBatch.from_pydict({**kept, **function(part.column(text_col).to_pylist())})

    return df.mapInArrow(batches, schema)


def ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each group of ``counts`` entries."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def mix(value: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    value = value ^ (value >> np.uint64(30))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(27)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    return value
