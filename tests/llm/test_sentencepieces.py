import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from helpers import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from lapstar.llm import sentencepieces as sp
from lapstar.llm.common import utf8
from lapstar.llm.queries import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
TEXTS = ["", " ", "  two  spaces ", "hello world", "Ununderstandable, really.\nNext\tline", "日本語 🙂 é é", "ab" * 150, "q" * 300]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def run(vocabulary, texts, rate, seed=0):
    data, offsets = utf8(pa.array(texts, pa.string()))
    keys = sp.text_keys(pa.array(range(len(texts)), pa.int64()), seed)
    ids, counts = sp.encode(vocabulary, data, offsets, keys, rate)
    back, bounds = sp.decode(vocabulary, ids, counts)
    assert np.array_equal(back, data) and np.array_equal(bounds, offsets)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def plain(vocabulary, library, text, key, rate):
    """The best candidate of the whole text again and again, by its pieces' texts; skipped ones are remembered."""
    text = "▁" + text.replace("▁", "\x00").replace(" ", "▁") if text else ""
    symbols = [(i, i + 1) for i in range(len(text))]
    skipped = set()
    pieces = {library.id_to_piece(i): i for i in range(259, library.get_piece_size())}
    while True:
        best = None
        for k in range(len(symbols) - 1):
            begin, end = symbols[k][0], symbols[k + 1][1]
            piece = pieces.get(text[begin:end])
            if piece is not None and (begin, symbols[k][1], end) not in skipped:
                if best is None or library.get_score(piece) > best[0]:
                    best = (library.get_score(piece), k, piece, begin, end)
        if best is None:
            break
        _, k, piece, begin, end = best
        drawn = sp.skipped(np.array([key]), np.array([begin]), np.array([end]), np.array([piece]), rate)[0] if rate else False
        if drawn:
            skipped.add((begin, symbols[k][1], end))
        else:
            symbols[k : k + 2] = [(begin, end)]
    out = []
    for begin, end in symbols:
        piece = pieces.get(text[begin:end])
        if piece is not None:
            out.append(piece)
        else:
            out += [int(vocabulary.bytes[b]) for b in text[begin:end].replace("\x00", "▁").encode()]
    return out


def test_without_dropout_as_the_library(vocabulary, library):
    assert run(vocabulary, TEXTS, 0.0) == library.encode(TEXTS)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6])
def test_against_a_plain_agenda(vocabulary, library, rate):
    texts = [t[:60] for t in TEXTS] + ["▁ a mark", "\x01 b"]
    keys = sp.text_keys(pa.array(range(len(texts)), pa.int64()), 5)
    found = run(vocabulary, texts, rate, 5)
    assert found == [plain(vocabulary, library, t, k, rate) for t, k in zip(texts, keys, strict=True)]


def test_long_units_have_equal_results(vocabulary, monkeypatch):
    texts = [*TEXTS, "unbelievable circumstances " * 5]
    rounds = run(vocabulary, texts, 0.2)
    monkeypatch.setattr(sp, "LONG_UNIT", 1)
    assert run(vocabulary, texts, 0.2) == rounds


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4), st.sampled_from([0.0, 0.3, 0.9]))
def test_lossless(vocabulary, texts, rate):
    run(vocabulary, [t.encode("utf-8", "ignore").decode() for t in texts], rate)


def test_seeds_vary_segmentations(vocabulary):
    text = ["several different words make segmentations vary between seeds"]
    found = {tuple(run(vocabulary, text, 0.3, seed)[0]) for seed in range(20)}
    assert len(found) > 10 and run(vocabulary, text, 0.3, 4) == run(vocabulary, text, 0.3, 4)


def test_frames(spark):
    rows = sp.encoded(odd_documents(spark), MODEL, 1).collect()
    assert len(rows) == 18 and all(r["lossless"] for r in rows)
    by_id = {}
    for row in rows:
        if row["doc_id"] is not None:
            assert by_id.setdefault(row["doc_id"], row["ids"]) == row["ids"]
    assert by_id[0] == by_id[1] == []
    short = sp.summary(odd_documents(spark), MODEL, 1).collect()
    assert sorted(r["n_pieces"] for r in short) == sorted(len(r["ids"]) for r in rows)
    assert sp.encoded(odd_documents(spark).limit(0), MODEL).collect() == []
    with pytest.raises(ValueError):
        sp.encoded(odd_documents(spark), MODEL, rate=1.0)
