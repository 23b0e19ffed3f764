"""Phrase collocations by the stripes pattern.

A prefix of one or two words keys a stripe, the counter of what follows it: next words, or nothing where its piece
ends. Every run of texts makes its own stripes; stripes of a prefix are merged elementwise. A merged stripe gives

* its total: how often the prefix occurs, as every occurrence is followed by one entry;
* its frequent entries: the phrases one word longer;
* the greatest of them: how often the prefix occurs at most inside a longer phrase that begins with it.

Prefixes of one word come first. A phrase of three words can only be frequent if both pairs in it are, so the second
pass over the texts makes stripes only of what passes a filter of all frequent pairs (a Bloom filter of a fixed size: what
passes by mistake is counted in full and dropped for its count).

Stripes are sorted by prefix and merged as they stream by. A prefix with more entries than ``WIDE`` over all runs is
cut into slices by a hash of the next word, so no task has to hold it; totals and maxima of slices are then combined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.llm.common import mix, utf8
from lapstar.llm.words import LOWER, text_of, word_ranges
from lapstar.session import save

LEAST = 10
SUBSUMED = 50
TOP = 2000
RUN_BYTES = 1 << 22
WIDE = 100_000
FILTER_BITS = 25
NO_LANG = "und"

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False
_PAIR = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))
STRIPE = "lang string, prefix string, nexts array<string>, counts array<long>"
MERGED = "lang string, prefix string, total long, nexts array<string>, counts array<long>"


def _hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of strings."""
    data, offsets = utf8(strings)
    raw, digest, at = data.tobytes(), xxhash.xxh3_64_intdigest, offsets.tolist()
    return np.fromiter((digest(raw[b:e]) for b, e in zip(at[:-1], at[1:], strict=True)), np.uint64, len(strings))


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths, one after the other in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


class Run:
    """The words of some texts: ``unit`` is the number of each word's entry in ``words`` and ``langs``, ``joined`` whether
    the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        data = LOWER[data]
        inside = _INSIDE[data]
        starts, ends = word_ranges(offsets, inside)
        found = _strings(data[inside], ends - starts).dictionary_encode()
        text = text_of(offsets, starts)
        langs = pc.fill_null(langs, NO_LANG).cast(pa.large_string()).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        code = lang * max(1, len(found.dictionary)) + found.indices.to_numpy(zero_copy_only=False)
        units, self.unit = np.unique(code, return_inverse=True)
        self.langs = langs.dictionary.take(pa.array(units // max(1, len(found.dictionary))))
        self.words = found.dictionary.take(pa.array(units % max(1, len(found.dictionary))))
        breaks = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_BREAK[data], out=breaks[1:])
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (breaks[starts[1:]] == breaks[ends[:-1]]) & (text[1:] == text[:-1])

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Codes of the pairs of words that begin at these places."""
        return self.unit[at] * len(self.words) + self.unit[at + 1]

    def stripes(self) -> pa.RecordBatch:
        """Of all words; a null entry counts where nothing follows."""
        n = len(self.words)
        at = np.flatnonzero(self.joined)
        codes, counts = np.unique(
            np.concatenate([self.unit[at] * (n + 1) + self.unit[at + 1], self.unit[~self.joined] * (n + 1) + n]),
            return_counts=True,
        )
        return _striped(self.langs, self.words, codes // (n + 1), codes % (n + 1), counts, self.words)

    def longer_stripes(self, known: np.ndarray) -> pa.RecordBatch:
        """Of pairs, as far as both pairs of the three words pass the filter."""
        n = len(self.words)
        at = np.flatnonzero(self.joined)
        codes, number = np.unique(self.pairs(at), return_inverse=True)
        first, second = codes // max(1, n), codes % max(1, n)
        passes = np.zeros(len(self.joined) + 1, np.int64) - 1
        lang, word = _hashes(self.langs), _hashes(self.words)
        slots = pair_slots(lang[first], word[first], word[second])
        good = np.ones(len(codes), bool)
        for slot in slots:
            good &= (known[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
        passes[at] = np.where(good[number], number, -1)
        begin = np.flatnonzero((passes[:-1] >= 0) & (passes[1:] >= 0))
        codes3, counts = np.unique(passes[begin] * max(1, n) + self.unit[begin + 2], return_counts=True)
        pair, last = codes3 // max(1, n), codes3 % max(1, n)
        used, pair = np.unique(pair, return_inverse=True)
        parts = [self.words.take(pa.array(x[used])) for x in (first, second)]
        prefix = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return _striped(self.langs.take(pa.array(first[used])), prefix, pair, last, counts, self.words)


def _striped(langs, prefixes, key: np.ndarray, entry: np.ndarray, counts: np.ndarray, words) -> pa.RecordBatch:
    """One row per key from entries sorted by key; the entry ``len(words)`` is null."""
    begin = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    cuts = pa.array(np.append(begin, len(key)).astype(np.int32))
    nexts = words.take(pa.array(entry, mask=entry == len(words)))
    at = pa.array(key[begin])
    return pa.RecordBatch.from_pydict({
        "lang": langs.take(at).cast(pa.string()), "prefix": prefixes.take(at).cast(pa.string()),
        "nexts": pa.ListArray.from_arrays(cuts, nexts.cast(pa.string())),
        "counts": pa.ListArray.from_arrays(cuts, pa.array(counts.astype(np.int64))),
    })


def pair_slots(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """Three bits of the filter for each pair, from the hashes of its language and words."""
    key = mix(mix(first * _PAIR[0] + lang) * _PAIR[1] + second)
    width = np.uint64(64 - FILTER_BITS)
    return [key >> width, mix(key + _PAIR[0]) >> width, mix(key + _PAIR[1]) >> width]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """Texts gathered to runs of about ``RUN_BYTES``; a longer text is a run of its own."""
    held, size = [], 0

    def run():
        table = pa.Table.from_batches(held).combine_chunks()
        return Run(*utf8(table["text"]), table["lang"].combine_chunks())

    for batch in batches:
        begin = 0
        _, offsets = utf8(batch.column("text"))
        while begin < len(batch):
            room = max(0, RUN_BYTES - size)
            end = int(np.searchsorted(offsets, offsets[begin] + room, "right")) - 1
            if end <= begin and held:
                yield run()
                held, size = [], 0
                continue
            end = min(len(batch), max(end, begin + 1))
            held.append(batch.slice(begin, end - begin))
            size += int(offsets[end] - offsets[begin])
            begin = end
    if held:
        yield run()


def _emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(batch), 20_000):
        yield batch.slice(begin, 20_000)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes cut into ``slices`` rows each, by a hash of the entries; nothing goes with the first slice."""
    for batch in batches:
        for i in range(len(batch)):
            nexts = batch.column("nexts")[i].values
            counts = batch.column("counts")[i].values
            n = batch.column("slices")[i].as_py()
            own = np.where(pc.is_null(nexts).to_numpy(zero_copy_only=False), 0, _hashes(nexts) % np.uint64(n))
            order = pa.array(np.argsort(own, kind="stable"))
            slices, cuts = np.unique(own, return_counts=True)
            bounds = pa.array(np.concatenate([[0], np.cumsum(cuts)]).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "lang": pa.repeat(batch.column("lang")[i], len(slices)), "prefix": pa.repeat(batch.column("prefix")[i], len(slices)),
                "nexts": pa.ListArray.from_arrays(bounds, nexts.take(order)),
                "counts": pa.ListArray.from_arrays(bounds, counts.take(order)), "slice": pa.array(slices.astype(np.int32)),
            })


def _changes(table: pa.Table) -> np.ndarray:
    """Whether each row has another key than the one before."""
    fresh = np.ones(len(table), bool)
    for name in ("lang", "prefix", "slice"):
        column = table[name].combine_chunks()
        other = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        fresh[1:] = other if name == "lang" else fresh[1:] | other
    return fresh


def _added(table: pa.Table) -> pa.Table:
    """Rows of equal keys, which follow each other, as one row each with their stripes added."""
    fresh = _changes(table)
    first = np.flatnonzero(fresh)
    nexts, counts = table["nexts"].combine_chunks(), table["counts"].combine_chunks()
    group = np.repeat(np.cumsum(fresh) - 1, nexts.value_lengths().to_numpy())
    flat = pa.table({"group": group, "next": nexts.flatten(), "count": counts.flatten()})
    flat = flat.group_by(["group", "next"], use_threads=False).aggregate([("count", "sum")])
    order = np.argsort(flat["group"].to_numpy(), kind="stable")
    bounds = pa.array(np.searchsorted(flat["group"].to_numpy()[order], np.arange(len(first) + 1)).astype(np.int32))
    rows = pa.array(first)
    return pa.table({
        "lang": table["lang"].take(rows), "prefix": table["prefix"].take(rows), "slice": table["slice"].take(rows),
        "nexts": pa.ListArray.from_arrays(bounds, flat["next"].combine_chunks().take(pa.array(order))),
        "counts": pa.ListArray.from_arrays(bounds, flat["count_sum"].combine_chunks().take(pa.array(order))),
    })


def _merge(least: int):
    """Merges sorted stripes; what is left of each are its total and its entries of ``least`` or more."""

    def finish(table: pa.Table) -> pa.RecordBatch:
        nexts, counts = table["nexts"].combine_chunks(), table["counts"].combine_chunks()
        sizes = nexts.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(table)), sizes)
        entry, count = nexts.flatten(), counts.flatten().to_numpy()
        total = np.zeros(len(table), np.int64)
        np.add.at(total, row, count)
        keep = (count >= least) & pc.is_valid(entry).to_numpy(zero_copy_only=False)
        bounds = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(table)))]).astype(np.int32))
        return pa.RecordBatch.from_pydict({
            "lang": table["lang"].combine_chunks(), "prefix": table["prefix"].combine_chunks(),
            "total": pa.array(total),
            "nexts": pa.ListArray.from_arrays(bounds, entry.filter(pa.array(keep))),
            "counts": pa.ListArray.from_arrays(bounds, pa.array(count[keep])),
        })

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch]).select(["lang", "prefix", "slice", "nexts", "counts"])
            table = _added(table if held is None else pa.concat_tables([held, table]))
            if len(table) > 1:
                yield finish(table.slice(0, len(table) - 1).combine_chunks())
            held = pa.Table.from_batches(table.slice(len(table) - 1).combine_chunks().to_batches())
        if held is not None:
            yield finish(held)

    return merge


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """``lang, prefix, total, nexts, counts`` of a stored table of stripes: one row per prefix, or slice of one."""
    wide = stripes.groupBy("lang", "prefix").agg(F.sum(F.size("nexts").cast("long")).alias("entries"))
    wide = save(wide.filter(F.col("entries") > WIDE), "wide")
    wide = wide.select("lang", "prefix", F.ceil(F.col("entries") / WIDE).cast("int").alias("slices"))
    narrow = stripes.join(wide, ["lang", "prefix"], "left_anti").withColumn("slice", F.lit(-1))
    cut = stripes.join(wide, ["lang", "prefix"]).mapInArrow(_cut, STRIPE + ", slice int")
    rows = narrow.unionByName(cut)
    parts = int(stripes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "lang", "prefix", "slice").sortWithinPartitions("lang", "prefix", "slice")
    return save(rows.mapInArrow(_merge(least), MERGED), "merged")


def _filter_of(pairs: DataFrame) -> np.ndarray:
    """A Bloom filter of all pairs, as 64-bit words; its parts are joined by a shuffle, its size is fixed."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_hashes(batch.column(name)) for name in ("lang", "first", "second")]
            slot = np.unique(np.concatenate(pair_slots(*own)))
            yield pa.RecordBatch.from_pydict({
                "word": pa.array((slot >> np.uint64(6)).astype(np.int64)),
                "bits": pa.array((np.uint64(1) << (slot & np.uint64(63))).view(np.int64)),
            })

    made = pairs.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    known = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    known[made["word"].to_numpy()] = made["bits"].to_numpy().view(np.uint64)
    return known


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 * a * a / (left * right))``, exact for counts below 10**15."""
    a, left, right = (f"CAST({x} AS DECIMAL(15,0))" for x in (a, left, right))
    return F.expr(f"({a} * {a} * CAST(1000000 AS DECIMAL(7,0))) div ({left} * {right})")


def _entries(rows: DataFrame) -> DataFrame:
    """One row per frequent entry of merged stripes: ``lang, prefix, next, a``."""
    entry = F.explode(F.arrays_zip("nexts", "counts")).alias("entry")
    found = rows.filter(F.size("nexts") > 0).select("lang", "prefix", entry)
    return found.select("lang", "prefix", F.col("entry.nexts").alias("next"), F.col("entry.counts").alias("a"))


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two or three words.

    A phrase occurs ``a`` times, ``least`` at least. Of its cuts into two parts that occur ``l`` and ``r`` times, the one
    with the least ``floor(1000000 * a * a / (l * r))`` counts, the first of equals. A phrase that is part of a longer one which
    occurs in at least ``subsumed`` percent of its own occurrences is left out. ``n`` counts all words of the language. Order is by
    score and ``a``, falling, then by phrase in the order of its bytes. Null texts are empty, a null language is
    ``und``; repeated rows count each; without texts there are no rows. Other columns are left out.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield from _emit(run.stripes())

    ones = merged(save(texts.mapInArrow(short, STRIPE), "stripes"), least)
    n = ones.groupBy("lang").agg(F.sum("total").alias("n"))
    counts = ones.groupBy(F.col("lang"), F.col("prefix").alias("word")).agg(F.sum("total").alias("f"))
    counts = save(counts.filter(F.col("f") >= least), "counts")
    pairs = save(_entries(ones).withColumnsRenamed({"prefix": "first", "next": "second"}), "pairs")
    left = counts.select("lang", F.col("word").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("word").alias("second"), F.col("f").alias("r"))
    pairs = save(pairs.join(left, ["lang", "first"]).join(right, ["lang", "second"]), "pairs")

    known = texts.sparkSession.sparkContext.broadcast(_filter_of(pairs.select("lang", "first", "second")))

    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            yield from _emit(run.longer_stripes(known.value))

    twos = merged(save(texts.mapInArrow(longer, STRIPE), "longer-stripes"), least)
    words = F.split("prefix", " ", 2)
    threes = _entries(twos).select(
        "lang", words[0].alias("w1"), words[1].alias("w2"), F.col("next").alias("w3"), F.col("a").alias("a3")
    )
    head = pairs.select(
        "lang", F.col("first").alias("w1"), F.col("second").alias("w2"), F.col("l").alias("l1"), F.col("a").alias("l2")
    )
    tail = pairs.select(
        "lang", F.col("first").alias("w2"), F.col("second").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2")
    )
    threes = save(threes.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"]), "threes")

    # Stripes of a pair know the greatest longer phrase that begins with it; those that end with it come from the phrases.
    behind = twos.filter(F.size("nexts") > 0).select("lang", words[0].alias("first"), words[1].alias("second"), F.array_max("counts").alias("most"))
    before = threes.select("lang", F.col("w2").alias("first"), F.col("w3").alias("second"), F.col("a3").alias("most"))
    most = behind.unionByName(before).groupBy("lang", "first", "second").agg(F.max("most").alias("most"))
    free = pairs.join(most, ["lang", "first", "second"], "left")
    free = free.filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * subsumed))

    short_phrases = free.select(
        "lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score")
    )
    cuts = threes.withColumn("s1", _score("a3", "l1", "r1")).withColumn("s2", _score("a3", "l2", "r2"))
    one = F.col("s1") <= F.col("s2")
    long_phrases = cuts.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("a3").alias("a"),
        F.when(one, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(one, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = short_phrases.unionByName(long_phrases).withColumn("rank", F.row_number().over(order).cast("long"))
    found = save(ranked.filter(F.col("rank") <= top), "phrases")
    return found.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
