"""Exact removal of repeated strings: every byte covered by a string of ``LENGTH`` bytes that starts elsewhere too.

Strings are found by refining buckets of positions (``suffixes``). Each level makes a table of names and places, sorts it
over the whole corpus by range, and looks at neighbours in that order: rows that share the coarser name with no other
row are done, rows that share both names with another are repeated, and the rest goes on to the next level.

* Anchors. A row stands for the strings whose anchor it is, a run of begins. The coarser name is the anchor's q-gram,
  the finer one that of all bytes of those strings.
* Cells. The run is cut at multiples of ``CELL``. The coarser name is that of the bytes that all strings of the cell
  share, the finer one again that of all bytes of the row's strings.
* Strings. Each begin is a row, with two independent names of its string.

Of rows that share both names one goes on beside the rest, if a row that is not settled shares its coarser name, since
strings of the latter may only recur there. The texts are stored once, bucketed by a row number, so that the joins
with each level's rows do not move them again. Range sorting splits a bucket of any size over many tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstar.llm.common import mix, ragged, slices, texts_of, utf8
from lapstar.llm.suffixes import LENGTH, Buckets, anchors
from lapstar.session import save

CELL = 16
ROW = "k1 long, k2 long, rid long, at long, known boolean"
_FLAGS = "part int, edge boolean, same1 boolean, same2 boolean, first boolean"


def packed(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """An anchor and the least and greatest distance of its strings' begins before it, in one number."""
    return at << 20 | low << 10 | high


def unpacked(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return value >> 20, value >> 10 & 1023, value & 1023


def _rows(k1: np.ndarray, k2: np.ndarray, rid: np.ndarray, at: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "k1": pa.array(k1.view(np.int64)), "k2": pa.array(k2.view(np.int64)), "rid": pa.array(rid), "at": pa.array(at),
        "known": pa.array(known),
    })


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """The anchors of all texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            rid = batch.column("rid").to_numpy()
            for begin, end in slices(offsets):
                bounds = offsets[begin : end + 1] - offsets[begin]
                buckets = Buckets(data[offsets[begin] : offsets[end]])
                grams = buckets.grams()
                at, first, last = anchors(grams, bounds)
                if len(at):
                    row = np.searchsorted(bounds, at, "right") - 1
                    low, high = at - last, at - first
                    whole = mix(buckets.names(first, last + LENGTH) + packed(low * 0, low, high).astype(np.uint64))
                    yield _rows(grams[at], whole, rid[begin + row], packed(at - bounds[row], low, high), np.zeros(len(at), bool))

    return texts.select("rid", "text").mapInArrow(find, ROW)


def _with_texts(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Each text with what ``rows`` (``rid, at, known``) has of it, in order; texts without rows are left out."""
    own = rows.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", "known"))).alias("own"))
    return texts.join(own, "rid").select("rid", "text", F.col("own.at").alias("at"), F.col("own.known").alias("known"))


def _finer(texts: DataFrame, rows: DataFrame, make) -> DataFrame:
    """The next level's rows: ``make`` turns the bytes of a run of texts and the rows' places into names and rows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            rid, places, known = batch.column("rid").to_numpy(), batch.column("at"), batch.column("known")
            for begin, end in slices(offsets):
                bounds = offsets[begin : end + 1] - offsets[begin]
                some = places.slice(begin, end - begin)
                value = some.flatten().to_numpy()
                marked = known.slice(begin, end - begin).flatten().to_numpy(zero_copy_only=False).astype(bool)
                row = np.repeat(np.arange(end - begin), some.value_lengths().to_numpy())
                k1, k2, source, at = make(data[offsets[begin] : offsets[end]], bounds[row], value)
                yield _rows(k1, k2, rid[begin + row[source]], at, marked[source])

    return _with_texts(texts, rows).mapInArrow(find, ROW)


def _cells(data: np.ndarray, begin: np.ndarray, value: np.ndarray):
    """Rows of cells from rows of anchors. ``begin`` is where each row's text begins in ``data``."""
    at, low, high = unpacked(value)
    count = high // CELL - low // CELL + 1
    source = np.repeat(np.arange(len(value)), count)
    cell = (low // CELL)[source] + ragged(count)
    own_low, own_high = np.maximum(low[source], cell * CELL), np.minimum(high[source], cell * CELL + CELL - 1)
    place = begin[source] + at[source]
    buckets = Buckets(data)
    shared = buckets.names(place - cell * CELL, place + LENGTH - (cell * CELL + CELL - 1))
    whole = buckets.names(place - own_high, place - own_low + LENGTH)
    k1 = mix(shared + cell.astype(np.uint64))
    k2 = mix(whole + packed(own_low * 0, own_low, own_high).astype(np.uint64))
    return k1, k2, source, packed(at[source], own_low, own_high)


def _strings(data: np.ndarray, begin: np.ndarray, value: np.ndarray):
    """Rows of single strings, by their begins in the text, from rows of cells."""
    at, low, high = unpacked(value)
    source = np.repeat(np.arange(len(value)), high - low + 1)
    place = at[source] - high[source] + ragged(high - low + 1)
    start = begin[source] + place
    return Buckets(data).names(start, start + LENGTH), Buckets(data, 1).names(start, start + LENGTH), source, place


def _neighbours(rows: DataFrame) -> DataFrame:
    """Rows that share ``k1`` with another, with flags: whether they share ``k2`` too, and are the first to do so."""
    keys = ["k1", "k2", "rid", "at"]
    rows = save(rows, "rows")  # else the range sampling would make them a second time
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions("k1", "k2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None  # the last row, until the next is known
        before: tuple[int, int] | None = None  # the keys of the row before it
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if len(batch) > 1:
                yield from emit(batch.slice(0, len(batch) - 1), part, before, batch.slice(len(batch) - 1))
                before = (batch.column("k1")[len(batch) - 2].as_py(), batch.column("k2")[len(batch) - 2].as_py())
            held = batch.slice(len(batch) - 1)
        if held is not None:
            yield from emit(held, part, before, None)

    def emit(batch, part, before, after):
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        last = (after.column("k1")[0].as_py(), after.column("k2")[0].as_py()) if after is not None else None
        like1, like2 = np.zeros(len(k1) + 1, bool), np.zeros(len(k1) + 1, bool)  # with the row before; the last: after
        like1[1:-1] = k1[1:] == k1[:-1]
        like2[1:-1] = like1[1:-1] & (k2[1:] == k2[:-1])
        if before is not None:
            like1[0], like2[0] = k1[0] == before[0], (k1[0], k2[0]) == before
        if last is not None:
            like1[-1], like2[-1] = k1[-1] == last[0], (k1[-1], k2[-1]) == last
        same1, same2 = like1[:-1] | like1[1:], like2[:-1] | like2[1:]
        edge = np.zeros(len(k1), bool)
        edge[0] |= before is None
        edge[-1] |= last is None
        keep = pa.array(same1 | edge)
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns |= {"part": pa.array(np.full(len(k1), part, np.int32)), "edge": pa.array(edge), "same1": pa.array(same1),
                    "same2": pa.array(same2), "first": pa.array(~like2[:-1])}
        yield pa.RecordBatch.from_pydict(columns).filter(keep)

    found = save(ordered.mapInArrow(compare, f"{ROW}, {_FLAGS}"), "neighbours")
    # Keys that go on in the next partition: two rows a partition at most are looked at here.
    borders = sorted((r["part"], r["k1"], r["k2"]) for r in found.filter("edge").select("part", "k1", "k2").collect())
    ends = {}
    for part, k1, k2 in borders:
        first, _ = ends.get(part, ((k1, k2), None))
        ends[part] = (first, (k1, k2))
    order = sorted(ends)
    meet = [(ends[p][1], ends[q][0]) for p, q in zip(order, order[1:], strict=False)]
    one = sorted({a[0] for a, b in meet if a[0] == b[0]})
    two = sorted({a for a, b in meet if a == b})
    if one:
        found = found.withColumn("same1", F.col("same1") | F.col("k1").isin(one))
    if two:
        # Names are 64-bit mixes of both keys' contents, so the pair is told by its second name among these few.
        found = found.withColumn(
            "same2", F.col("same2") | (F.col("k1").isin([a for a, _ in two]) & F.col("k2").isin([b for _, b in two]))
        )
    return found.filter("same1")


def _going_on(rows: DataFrame) -> DataFrame:
    """Rows for the next level: those that are not settled, and for each settled pair of names one row, if a row that
    is not settled shares its coarser name. The latter count as known."""
    # Stored, so that Spark knows its size: a small one is broadcast before anything is dealt by a frequent name.
    open_ = save(rows.filter("not same2 and not known").select("k1").distinct(), "open-names")
    some = rows.filter("not same2 or first")
    return some.join(open_, "k1", "left_semi").select("rid", "at", (F.col("known") | F.col("same2")).alias("known"))


def _settled(rows: DataFrame) -> DataFrame:
    """``rid, first, last``: runs of begins of repeated strings."""
    at, low, high = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023), F.col("at").bitwiseAND(1023)
    rows = rows.filter("same2 and not known")
    return rows.select("rid", (at - high).alias("first"), (at - low).alias("last"))


def covered(first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes (begins, ends) that strings with these begins cover."""
    order = np.argsort(first, kind="stable")
    begin, end = first[order], np.maximum.accumulate(last[order] + length)
    fresh = np.concatenate([[True], begin[1:] > end[:-1]]) if len(begin) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    return begin[at], np.maximum.reduceat(end, at) if len(at) else end


def repeated_runs(texts: DataFrame) -> DataFrame:
    """``rid, first, last``: the begins of all repeated strings of the table ``texts`` (``rid, text``), as runs."""
    level = _neighbours(_anchor_rows(texts))
    found = _settled(level)
    level = _neighbours(_finer(texts, save(_going_on(level), "open"), _cells))
    found = found.unionByName(_settled(level))
    level = _neighbours(_finer(texts, save(_going_on(level), "open"), _strings))
    begins = level.filter("same2 and not known").select("rid", F.col("at").alias("first"), F.col("at").alias("last"))
    return found.unionByName(begins)


def _cut(texts: DataFrame, runs: DataFrame, with_bytes: bool) -> DataFrame:
    """Each text without its repeated bytes."""
    own = runs.groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("own"))
    joined = texts.join(own, "rid", "left")
    joined = joined.select("doc_id", "text", F.col("own.first").alias("first"), F.col("own.last").alias("last"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            columns: dict[str, list] = {x: [] for x in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            rest = []
            for i in range(len(batch)):
                raw = data[offsets[i] : offsets[i + 1]]
                first, last = batch.column("first")[i], batch.column("last")[i]
                begins = ends = np.zeros(0, np.int64)
                if first.is_valid:
                    begins, ends = covered(first.values.to_numpy(), last.values.to_numpy())
                kept = b"".join(
                    raw[b:e].tobytes() for b, e in zip([0, *ends.tolist()], [*begins.tolist(), len(raw)], strict=True)
                )
                columns["n_bytes"].append(len(raw))
                columns["n_removed"].append(len(raw) - len(kept))
                columns["n_spans"].append(len(begins))
                columns["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                rest.append(kept)
            if with_bytes:
                columns["kept"] = pa.array(rest, pa.binary())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(cut, schema + (", kept binary" if with_bytes else ""))


def remove_repeats(docs: DataFrame, text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``, and with ``with_bytes`` what is
    kept of its UTF-8 bytes.

    A null text is empty; texts shorter than ``LENGTH`` bytes keep all. Repeated rows repeat each other's strings.
    Columns other than ``doc_id`` and the text are left out. The texts' table is dropped at the end.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"repeats_{uuid.uuid4().hex}"
    rows = texts_of(docs, text_col=text_col).withColumn("rid", F.monotonically_increasing_id()).repartition(parts, "rid")
    rows.write.bucketBy(parts, "rid").option("compression", "zstd").saveAsTable(name)
    try:
        texts = spark.table(name)
        return save(_cut(texts, repeated_runs(texts), with_bytes), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
