import re

import numpy as np
import pytest
from helpers import documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from lapstar.llm import wordpieces
from lapstar.llm.queries import QUERIES, TOKENIZERS

VOCABULARY = wordpieces.read_vocabulary(f"{TOKENIZERS}/word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def greedy(word, entries):
    """The longest entry at the front, again and again; -1 if there is none."""
    at = n = 0
    while at < len(word):
        for end in range(min(len(word), at + 70), at, -1):
            if (word[at:end], False) in entries or (end == len(word) and (word[at:end], True) in entries):
                break
        else:
            return -1
        at, n = end, n + 1
    return n


def words(text):
    raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[!-/:-@\[-`{-~]|[^\x20\x09-\x0D!-/:-@\[-`{-~]+", raw)


def brute(text, entries):
    counts = [greedy(w, entries) for w in words(text)]
    return len(counts), sum(1 if c < 0 else c for c in counts), sum(c < 0 for c in counts)


entry = st.tuples(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), st.booleans())


@settings(max_examples=150, deadline=None)
@given(st.lists(entry, max_size=12), st.lists(st.text("abc", min_size=1, max_size=90), max_size=8))
def test_against_greedy_search(vocabulary, texts):
    automaton = wordpieces.Automaton(vocabulary)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    want = [greedy(t.encode(), set(vocabulary)) for t in texts]
    assert automaton.counts(data, ends - [len(t) for t in texts], ends).tolist() == want
    assert [automaton.count(t.encode()) for t in texts] == want


def test_query(spark):
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_token_counts"](spark, SF).collect()}
    entries = set(VOCABULARY)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert found == {r["doc_id"]: brute(r["text"], entries) for r in docs}


@pytest.mark.parametrize("vocabulary", [VOCABULARY, [(b"a", False), (b"ab", True)], []])
def test_frames(spark, vocabulary):
    docs = odd_documents(spark)
    found = wordpieces.count_pieces(docs, vocabulary)
    want = sorted(((r["doc_id"], *brute(r["text"], set(vocabulary))) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert wordpieces.count_pieces(docs.limit(0), vocabulary).collect() == []
    assert wordpieces.count_pieces(documents(spark, [(1, "ab")]), [(b"ab", True)]).first()["n_tokens"] == 1
