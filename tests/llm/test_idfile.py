import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapstar.llm import huffman, idfile
from lapstar.llm.common import utf8
from lapstar.llm.queries import QUERIES, TOKENIZERS

PATH = f"{TOKENIZERS}/word_bpe_49k.json"
SF = "/root/testdata/sf0.001"
TEXTS = [
    "", " ", "ΑΣ ΣΑ İstanbul. Ñasmente, ǅa ÀÉ! ﬁne ⅷ ªb ßẞ", "a<|endoftext|>b <|startoftext|>", "tab\there nb\xa0 é ΑΣ.",
    "it's don't 'S 12345 \r\n\r\n a\x1cb \x85 c", "　日本語 テスト🙂👍🏽 ", "q" * 3000, "e ́x ́", "A ̊", ". , ;;", "x\x01y \x01 z",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def plain_cost(counts):
    """Bits of an unlimited Huffman code."""
    heap = [int(x) for x in counts if x]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_code_lengths_are_the_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = rng.integers(0, 40, rng.integers(2, 60))
        lengths = huffman.code_lengths(counts)
        assert (lengths * counts).sum() == plain_cost(counts) or (counts > 0).sum() < 2


def test_lengths_are_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    for limit in (4, 5, 6, 11):
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and np.isclose((2.0 ** -lengths.astype(float)).sum(), 1)
    # With 4 bits for 12 symbols: the best of all ways to spend the room.
    best = min(
        sum(sorted(counts)[::-1][i] * bits for i, bits in enumerate([1] * a + [2] * b + [3] * c + [4] * (12 - a - b - c)))
        for a in range(2) for b in range(4) for c in range(8)
        if a + b + c <= 12 and a / 2 + b / 4 + c / 8 + (12 - a - b - c) / 16 <= 1
    )
    assert (huffman.code_lengths(counts, 4) * counts).sum() == best
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(17), 4)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=600), st.integers(0, 4), st.integers(0, 6))
def test_blocks_decode_alone(symbols, first, more):
    symbols = np.array(symbols, np.int64)
    code = huffman.Code(huffman.code_lengths(np.bincount(symbols, minlength=301)))
    payload, marks = code.encode(symbols)
    assert np.array_equal(code.decode(payload, marks, len(symbols)), symbols)
    first = min(first, len(marks))
    last = min(len(marks), first + more)
    part = code.decode(payload, marks, len(symbols), first=first, last=last)
    assert np.array_equal(part, symbols[first * huffman.BLOCK : last * huffman.BLOCK])


def test_words_as_the_tokenizer(tokenizer, monkeypatch):
    for known in (idfile.KNOWN_WORDS, 5):
        monkeypatch.setattr(idfile, "KNOWN_WORDS", known)
        words = idfile.Words(PATH)
        for texts in (TEXTS, TEXTS[::-1], TEXTS * 2):
            data, offsets = utf8(pa.array(texts))
            ids, lengths = words.encode(data, offsets, 1)
            assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [direct(tokenizer, t) for t in texts]


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = direct(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document(spark, tokenizer):
    found = QUERIES["op3_token_ids"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected(tokenizer, [tuple(r) for r in docs])
    assert sorted(tuple(r) for r in found.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_files_ascend(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(idfile, "SEGMENT_BYTES", 50)
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 5)]
    folder = idfile.encoded_folder(documents(spark, rows), PATH)
    read = idfile.read_ids(spark, folder).collect()
    ids = [x for r in sorted(read, key=lambda r: r["start"]) for x in r["ids"]]
    assert ids == [x for i, t in sorted(rows) for x in direct(tokenizer, t)]
    segments = spark.read.schema(idfile.SEGMENTS).parquet(f"{folder}/segments").orderBy("part", "seq").collect()
    assert [x for s in segments for x in s["doc_ids"]] == sorted(i for i, _ in rows) and len(segments) > 1


def test_frames(spark, tokenizer):
    docs = odd_documents(spark)
    found = idfile.read_summary(spark, idfile.encoded_folder(docs, PATH)).collect()
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(direct(tokenizer, r["text"]))) for r in docs.collect())
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in found) == want
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [sum(x["n_tokens"] for x in ordered[:i]) for i in range(len(ordered))]
    empty = idfile.encoded_folder(docs.limit(0), PATH)
    assert idfile.read_summary(spark, empty).collect() == [] and idfile.read_ids(spark, empty).collect() == []


def test_long_words_of_a_regular_build(spark):
    """Sums of powers modulo 2**64 take a Thue-Morse word for its complement from 1,024 letters on."""
    from helpers import documents, thue_morse
    from tokenizers import Tokenizer

    docs = []
    for n in (256, 1024, 4096):
        a, b = thue_morse(n)
        docs += [a + " x " + b, b + " " + a + " " + b]
    path = "/opt/tokenizers/word_bpe_49k.json"
    frame = documents(spark, list(enumerate(docs))).coalesce(1)
    found = sorted(map(tuple, idfile.read_summary(spark, idfile.encoded_folder(frame, path)).collect()))
    tokenizer, at = Tokenizer.from_file(path), 0
    for row, text in zip(found, docs, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert row[1:4] == (at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        at += len(ids)
