"""Benchmark decontamination: test items that occur in documents with few edits.

An item of m letters may be found with up to ``rate * m`` edits, rounded down. Cut into one piece more than that, at
least one piece must occur unchanged in any such passage. An item of fewer than ``LEAST_LETTERS`` letters is found
unchanged only, and where no letter or digit comes right before or behind it. So the texts are searched for exact pieces, by the hash of the
bytes with which a piece begins at every position, and around each hit the item is verified by Myers' bit-parallel edit
distance.

Texts and items are compared with A-Z as a-z and runs of white space as one space. The benchmark goes to the tasks in
blocks of bounded size, each block in a pass of its own, so a benchmark of any size can be used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstar.llm.common import slices, texts_of, utf8
from lapstar.llm.words import LOWER, SPACE, Ranges

RATE = 0.08
LEAST_LETTERS = 20
BLOCK_BYTES = 1 << 22
ANCHORS = (16, 12, 10, 8, 6, 4, 3, 2, 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with single spaces, where each text begins, and where each byte was."""
    space = SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = space[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = False
    at = np.flatnonzero(~(space & before))
    kept = LOWER[data[at]]
    kept[space[at]] = 0x20
    return kept, np.searchsorted(at, offsets), at


def normal_text(text: str) -> str:
    raw = np.frombuffer(text.encode(), np.uint8)
    return normal(raw, np.array([0, len(raw)]))[0].tobytes().decode().strip(" ")


class Pattern:
    """An item for Myers' algorithm: for each letter the positions it has in the item, as bits."""

    def __init__(self, text: str):
        self.size, self.where = len(text), {}
        for i, letter in enumerate(text):
            self.where[letter] = self.where.get(letter, 0) | 1 << i

    def distances(self, text: str, anchored: bool = False) -> Iterator[int]:
        """After each letter of ``text``, the least distance of the item to a passage that ends there.

        The passage may begin anywhere, or with ``anchored`` only at the first letter.
        """
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score, where = full, 0, self.size, self.where
        for letter in text:
            equal = where.get(letter, 0)
            vertical = equal | minus
            equal |= (((equal & plus) + plus) ^ plus)
            up = minus | ~(equal | plus) & full
            down = plus & equal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 | anchored
            down <<= 1
            plus = (down | ~(vertical | up)) & full
            minus = up & vertical & full
            yield score


@dataclass
class Item:
    item_id: int
    text: str
    budget: int
    alone: bool = False
    forward: Pattern = field(init=False)
    backward: Pattern = field(init=False)

    def __post_init__(self):
        self.forward, self.backward = Pattern(self.text), Pattern(self.text[::-1])

    def find(self, text: str) -> tuple[int, int, int] | None:
        """Distance, begin and end of the best passage within the budget, the first of equals."""
        best, end = self.budget + 1, 0
        for i, distance in enumerate(self.forward.distances(text), 1):
            if distance < best:
                best, end = distance, i
        if best > self.budget:
            return None
        size = 0
        for i, distance in enumerate(self.backward.distances(text[:end][::-1], anchored=True), 1):
            if distance == best:
                size = i
                break
        return best, end - size, end


def _alone(raw: bytes, begin: int, end: int) -> bool:
    """Whether no letter or digit touches the bytes from ``begin`` to ``end``."""
    before = raw[max(0, begin - 4) : begin].decode(errors="ignore")[-1:]
    behind = raw[end : end + 4].decode(errors="ignore")[:1]
    return not before.isalnum() and not behind.isalnum()


class Index:
    """The pieces of a block of items, by the hash of their first bytes."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.items = [
            Item(item_id, text, 0 if len(text) < LEAST_LETTERS else int(rate * len(text)), len(text) < LEAST_LETTERS)
            for item_id, text in items
        ]
        self.by_size: dict[int, dict[int, list[tuple[int, int, bytes]]]] = {}
        for number, item in enumerate(self.items):
            pieces, m = item.budget + 1, len(item.text)
            for k in range(pieces):
                begin, end = k * m // pieces, (k + 1) * m // pieces
                raw = item.text[begin:end].encode()
                size = next(x for x in ANCHORS if x <= len(raw))
                anchor = np.frombuffer(raw[:size], np.uint8)
                key = int(self._hashes(Ranges(anchor), size)[0])
                place = len(item.text[:begin].encode())
                self.by_size.setdefault(size, {}).setdefault(key, []).append((number, place, raw))
        self.bits = max(16, sum(map(len, self.by_size.values())).bit_length() + 6)
        self.marks = {}
        for size, keys in self.by_size.items():
            marks = np.zeros(1 << self.bits, bool)
            marks[np.array(list(keys), np.uint64) >> np.uint64(64 - self.bits)] = True
            self.marks[size] = marks

    @staticmethod
    def _hashes(ranges: Ranges, size: int) -> np.ndarray:
        """Of the ``size`` bytes from every position on."""
        return ranges.windows(size) * _ODD

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """By text and item, the positions at which the item would begin for a piece of it to be where it is."""
        found: dict[tuple[int, int], list[int]] = {}
        ranges = Ranges(data)
        raw = data.tobytes()
        for size, keys in self.by_size.items():
            if len(data) < size:
                continue
            hashes = self._hashes(ranges, size)
            at = np.flatnonzero(self.marks[size][hashes >> np.uint64(64 - self.bits)])
            for position, key in zip(at.tolist(), hashes[at].tolist(), strict=True):
                for number, place, piece in keys.get(key, ()):
                    if raw.startswith(piece, position):
                        text = int(np.searchsorted(offsets, position, "right")) - 1
                        end = position + len(piece)
                        if end <= offsets[text + 1]:
                            if self.items[number].alone and not _alone(raw[offsets[text] : offsets[text + 1]], position - offsets[text], end - offsets[text]):
                                continue
                            found.setdefault((text, number), []).append(position - place)
        return found

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Text number, item number, distance, begin and end (code points of the text) of each item's best passage."""
        kept, bounds, at = normal(data, offsets)
        found = []
        for (text, number), begins in sorted(self.hits(kept, bounds).items()):
            item = self.items[number]
            slack, size = 4 * item.budget, len(item.text.encode())
            best, low, high = None, None, None
            for begin in [*sorted(set(begins)), None]:
                if low is not None and (begin is None or begin > high + size + slack):
                    # One window for all hits whose windows touch.
                    first, last = max(int(bounds[text]), low - slack), min(int(bounds[text + 1]), high + size + slack)
                    while first > bounds[text] and kept[first] & 0xC0 == 0x80:
                        first -= 1
                    while last < bounds[text + 1] and kept[last] & 0xC0 == 0x80:
                        last += 1
                    window = kept[first:last].tobytes().decode()
                    passage = item.find(window)
                    if passage and (best is None or passage[0] < best[0]):
                        best = (passage[0], first + len(window[: passage[1]].encode()), first + len(window[: passage[2]].encode()))
                    low = None
                if begin is not None:
                    low, high = begin if low is None else low, begin
            if best:
                raw = data[offsets[text] : offsets[text + 1]]
                letter = np.cumsum((raw & 0xC0) != 0x80)
                begin, end = int(at[best[1]] - offsets[text]), int(at[best[2] - 1] - offsets[text])
                found.append((text, number, best[0], int(letter[begin]) - 1, int(letter[end])))
        return found


def blocks(benchmark: DataFrame, rate: float = RATE) -> Iterator[Index]:
    """The items in blocks of about ``BLOCK_BYTES``. Items with equal normalised texts are one, under their smallest id,
    or null if none has one; null items and those of white space only are left out."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).alias("text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text)
    items = items.filter("text <> ''")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == block).collect()  # BLOCK_BYTES on average
        if rows:
            yield Index(sorted(((row["item_id"], row["text"]) for row in rows), key=lambda x: (x[0] is None, x)), rate)


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, distance, start, stop``: for each document and item it holds, the best passage.

    ``start`` and ``stop`` (exclusive) are code points of the text. Clean documents have no row; null and empty texts
    hold nothing; repeated rows give their rows each. An item without an id has a row with a null ``item_id``. Without
    items the result is empty. Columns of ``docs`` other than ``doc_id`` and the text are left out.
    """
    texts = texts_of(docs, text_col=text_col)
    schema = "doc_id long, item_id long, distance int, start int, stop int"
    found = docs.sparkSession.createDataFrame([], schema)

    def search(index: Index):
        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                data, offsets = utf8(batch.column("text"))
                for begin, end in slices(offsets):
                    part = offsets[begin : end + 1]
                    hits = index.search(data[part[0] : part[-1]], part - part[0])
                    if hits:
                        text, number, distance, start, stop = (list(x) for x in zip(*hits, strict=True))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": batch.column("doc_id").take(pa.array([begin + x for x in text])),
                            "item_id": pa.array([index.items[x].item_id for x in number], pa.int64()),
                            "distance": pa.array(distance, pa.int32()),
                            "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32()),
                        })

        return batches

    for number, index in enumerate(blocks(benchmark, rate)):
        part = texts.mapInArrow(search(index), schema)
        found = found.unionByName(part) if number else part
    return found


def without_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item, whether it has an id or not.

    Null and empty texts stay; repeated rows stay or go together. Without items all rows stay.
    """

    def clean(index: Index):
        def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                data, offsets = utf8(batch.column(text_col))
                keep = np.ones(len(batch), bool)
                for begin, end in slices(offsets):
                    part = offsets[begin : end + 1]
                    hits = index.search(data[part[0] : part[-1]], part - part[0])
                    keep[[begin + x[0] for x in hits]] = False
                yield batch.filter(pa.array(keep))

        return batches

    for index in blocks(benchmark, rate):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs
