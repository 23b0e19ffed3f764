"""Token ids on disk: canonical Huffman coding from the counts of the whole corpus.

Documents are put in ascending order once, by a range shuffle of their texts, and encoded to ids in that order. The
ids are counted over the whole corpus, which gives one code of limited length. Segments of whole documents are then
written as rows: the ids' bits, how many bits each block of ``huffman.BLOCK`` ids takes (from which the bit offsets
of the blocks follow, so each can be decoded alone), and the documents' lengths. A folder holds

    code/                 one row per token id that occurs: ``id, bits``
    segments/part=…/      ``seq, first, doc_ids, lengths, marks, payload``, parts and sequences ascending

A word is encoded by the tokenizer once per worker; a text's ids are put together from its words', which is exact for
a tokenizer whose pieces never span a space.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstar.llm.common import slices, texts_of, utf8
from lapstar.llm.huffman import Code, code_lengths
from lapstar.llm.words import word_hashes, word_ranges
from lapstar.session import new_path, save, scratch

SEGMENT_BYTES = 1 << 20
TABLE_BITS = 21
KNOWN_WORDS = 1 << 20
WORDS_AT_ONCE = 100
END_ID = 1
END_MARK = "</w>"
BREAK = np.zeros(256, bool)
BREAK[[0x20, 0x0A]] = True
ODD_CASE = frozenset("\u03a3\u0130")  # lower-cased by their surroundings, or to more than a letter
STOPS = frozenset(".,;:!?")


class Words:
    """Ids of space-free words, kept for the words seen so far.

    Words are known by a 64-bit hash of their bytes in a hash table of arrays, which takes some 30 bytes a word and is
    looked up for all words of a run of texts at once; when it is full it starts anew. Unknown words of letters are
    lower-cased here and encoded many at a time, by the same model without the normalising and splitting that they do
    not need: such a word is one run of letters to the tokenizer and ends with an id that carries the end mark. A stop
    behind a word is a run of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for text, i in vocabulary.items() if text.endswith(END_MARK)]] = True
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)  # 0: free
        self.rows = np.zeros(1 << TABLE_BITS, np.int32)
        self.begins = np.zeros(KNOWN_WORDS, np.int64)
        self.lengths = np.zeros(KNOWN_WORDS, np.int32)
        self.pool = np.zeros(8 * KNOWN_WORDS, self.kind)
        self.known = self.pooled = 0

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind) for x in found]

    def _singly(self, words: list[str]) -> dict[str, bytes]:
        return {word: ids.tobytes() for word, ids in zip(words, self._ids(words), strict=True)}

    def _plain(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters."""
        out: dict[str, bytes] = {}
        runs = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        for run, ids in zip(runs, self._ids([" ".join(run) for run in runs], self.letters), strict=True):
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(ends) == len(run):
                raw = ids.tobytes()
                out.update((word, raw[b:e]) for word, b, e in zip(run, [0, *ends[:-1]], ends, strict=True))
            else:
                out.update(self._singly(run))
        return out

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        rest, parts = [], []
        for word in words:
            core, stop = word, ""
            if core[-1:] in STOPS:
                core, stop = core[:-1], core[-1:]
            if core.isalpha() and (core.isascii() or (is_normalized("NFC", core) and not ODD_CASE & set(core))):
                core = core.lower()
                if core.isalpha():
                    parts.append((word, core, stop))
                    continue
            rest.append(word)
        found = self._singly(rest)
        cores = self._plain(list({core for _, core, _ in parts}))
        stops = self._singly(list({stop for _, _, stop in parts}))
        for word, core, stop in parts:
            found[word] = cores[core] + stops[stop]
        return [found[word] for word in words]

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        mask = len(self.keys) - 1
        slot = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == keys, self.rows[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.rows[slot[open_[hit]]]
            open_ = open_[~hit & (found != 0)]
        return out

    def _add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        """Adds distinct unknown keys."""
        lengths = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        total = int(lengths.sum())
        if self.pooled + total > len(self.pool):
            more = np.zeros(max(len(self.pool), total), self.kind)
            self.pool = np.concatenate([self.pool, more])
        self.pool[self.pooled : self.pooled + total] = np.frombuffer(b"".join(ids), self.kind)
        rows = np.arange(self.known, self.known + len(keys))
        self.begins[rows] = self.pooled + np.cumsum(lengths) - lengths
        self.lengths[rows] = lengths
        self.known, self.pooled = self.known + len(keys), self.pooled + total
        mask, left = len(self.keys) - 1, np.arange(len(keys))
        slot = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot[left]] == keys[left]
            self.rows[slot[left[placed]]] = rows[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & mask

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, ``end_id`` behind each, and how many each text has."""
        starts, ends = word_ranges(offsets, ~BREAK[data])
        keys = word_hashes(data, starts, ends)
        keys[keys == 0] = 1
        rows = self._look_up(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            unknown, first = np.unique(keys[new], return_index=True)
            if self.known + len(unknown) > KNOWN_WORDS:
                self._forget()
                unknown, first = np.unique(keys, return_index=True)
                new = np.arange(len(keys))
            if len(unknown) > KNOWN_WORDS:  # more words in one text than the table holds
                return self._encode_parts(data, offsets, end_id)
            raw, at = data.tobytes(), new[first]
            words = [raw[b:e].decode() for b, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._add(unknown, self.word_ids(words))
            rows[new] = self._look_up(keys[new])
        # The end id of each text is one more item, behind the text's words.
        upto = np.searchsorted(starts, offsets[1:])
        begins, lengths = np.insert(self.begins[rows], upto, -1), np.insert(self.lengths[rows], upto, 1)
        bounds = np.cumsum(lengths, dtype=np.int64)
        at = np.arange(bounds[-1] if len(bounds) else 0) + np.repeat(begins - (bounds - lengths), lengths)
        ids = self.pool[np.maximum(at, 0)]
        text_ends = bounds[upto + np.arange(len(upto))]
        ids[text_ends - 1] = end_id
        return ids, np.diff(text_ends, prepend=0)

    def _encode_parts(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts with very many different words: in parts that end at a break."""
        found, counts = [], []
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            n = 0
            while begin < end:
                upto = min(end, begin + KNOWN_WORDS)
                breaks = np.flatnonzero(BREAK[data[begin:upto]])
                if upto < end:
                    later = np.flatnonzero(BREAK[data[upto:end]])
                    upto = begin + int(breaks[-1]) + 1 if len(breaks) else upto + int(later[0]) + 1 if len(later) else end
                ids, _ = self.encode(data[begin:upto], np.array([0, upto - begin]), end_id)
                found.append(ids[:-1])
                n += len(ids) - 1
                begin = upto
            found.append(np.array([end_id], self.kind))
            counts.append(n + 1)
        return np.concatenate(found), np.array(counts)


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One per worker process and tokenizer, so that tasks share what is known."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID, text_col: str = "text") -> DataFrame:
    """Segments of ids in ascending order of ``doc_id`` (nulls first; equal ids by their texts)."""
    texts = texts_of(docs, text_col=text_col)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    texts = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for begin, end in slices(offsets, SEGMENT_BYTES):
                bounds = offsets[begin : end + 1]
                ids, lengths = words.encode(data[bounds[0] : bounds[-1]], bounds - bounds[0], end_id)
                one = pa.array([0, end - begin], pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(one, batch.column("doc_id").slice(begin, end - begin)),
                    "lengths": pa.ListArray.from_arrays(one, pa.array(lengths, pa.int64())),
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                })
                seq, before = seq + 1, before + len(ids)

    schema = "part int, seq int, before long, doc_ids array<long>, lengths array<long>, ids binary"
    return texts.mapInArrow(encode, schema)


def id_counts(segments: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs in the corpus. Each task sends one row per id it has met, the driver gets ``size`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column("ids"):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    counts = np.zeros(size, np.int64)
    rows = segments.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in rows.collect():
        counts[row["id"]] = row["n"]
    return counts


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, text_col: str = "text") -> None:
    """Writes the ids of every document, with ``end_id`` behind each, to ``folder``.

    A null or empty text has the end id only. Repeated rows are written each. An empty table gives an empty folder
    that can be read back.
    """
    spark = docs.sparkSession
    words = words_of(tokenizer)
    kind, size = words.kind, max(words.size, end_id + 1)
    with scratch(spark):
        segments = save(tokenized(docs, tokenizer, end_id, text_col), "ids")
        code = Code(code_lengths(id_counts(segments, kind, size)))
        # One row per part; parts are the partitions of the range shuffle.
        totals = segments.groupBy("part").agg(F.max(F.col("before") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
        first, upto = {}, 0
        for part, n in sorted(totals.collect()):
            first[part], upto = upto, upto + n

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    row = batch.slice(i, 1)
                    payload, marks = code.encode(np.frombuffer(row.column("ids")[0].as_buffer(), kind))
                    begin = first[row.column("part")[0].as_py()] + row.column("before")[0].as_py()
                    yield pa.RecordBatch.from_pydict({
                        **{name: row.column(name) for name in ("part", "seq", "doc_ids", "lengths")},
                        "first": pa.array([begin], pa.int64()),
                        "marks": pa.array([marks.astype("<u2").tobytes()], pa.binary()),
                        "payload": pa.array([payload], pa.binary()),
                    })

        schema = "part int, seq int, doc_ids array<long>, lengths array<long>, first long, marks binary, payload binary"
        coded = segments.mapInArrow(encode, schema)
        coded.sortWithinPartitions("part", "seq").write.partitionBy("part").parquet(f"{folder}/segments")
        used = np.flatnonzero(code.lengths)
        rows = [(int(i), int(code.lengths[i])) for i in used]
        spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")


SEGMENTS = "seq int, doc_ids array<long>, lengths array<long>, first long, marks binary, payload binary, part int"


def read_code(spark: SparkSession, folder: str) -> Code:
    """The code of a folder; it has a row per token id at most."""
    rows = spark.read.schema("id int, bits int").parquet(f"{folder}/code").collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for row in rows:
        lengths[row["id"]] = row["bits"]
    return Code(lengths)


def _documents(batch: pa.RecordBatch, code: Code) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(len(batch)):
        lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
        marks = np.frombuffer(batch.column("marks")[i].as_buffer(), "<u2")
        n = int(lengths.sum())
        ids = code.decode(batch.column("payload")[i].as_py(), marks, n).astype("<u4")
        ends = np.cumsum(lengths)
        yield batch.column("doc_ids")[i].as_py(), batch.column("first")[i].as_py() + ends - lengths, ends, ids


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document, decoded from the files."""
    code = read_code(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, starts, ends, ids in _documents(batch, code):
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                })

    return spark.read.schema(SEGMENTS).parquet(f"{folder}/segments").mapInArrow(decode, "doc_id long, start long, ids array<int>")


def read_summary(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the decoded ids as 32-bit little-endian numbers."""
    code = read_code(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, starts, ends, ids in _documents(batch, code):
                raw, begins = memoryview(ids.tobytes()), np.concatenate([[0], ends])
                crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins[:-1].tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(np.diff(begins), pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                })

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return spark.read.schema(SEGMENTS).parquet(f"{folder}/segments").mapInArrow(decode, schema)


def encoded_folder(docs: DataFrame, tokenizer: str, text_col: str = "text") -> str:
    """Writes the ids of ``docs`` to a new folder in the shared one."""
    folder = new_path(docs.sparkSession, "token-ids")
    write_ids(docs, folder, tokenizer, text_col=text_col)
    return folder
