import random

import numpy as np
import pytest
from helpers import documents, odd_documents, pairs

from lapstar.llm import decontaminate as dec


def distances(item, text):
    """The least distance of ``item`` to a passage of ``text`` that ends behind each letter."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        after = [i]
        for j, b in enumerate(text, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (a != b)))
        row = after
    return row


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def edit(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        text[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice("abcdefgh é")]
    return "".join(text)


@pytest.fixture(scope="module")
def world():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh é ") for _ in range(n))
    items = [(i, text(rng.randrange(22, 160))) for i in range(25)]
    items += [(50, items[0][1].upper()), (60, "short"), (61, None), (62, ""), (None, text(60)), (63, items[1][1][:40])]
    docs = []
    for i in range(120):
        item = items[rng.randrange(25)][1]
        budget = int(dec.RATE * len(dec.normal_text(item)))
        passage = edit(rng, item, rng.randrange(0, budget + 3))
        if i % 3 == 0:
            passage = passage.replace(" ", " \n ").upper()
        docs.append((i, text(rng.randrange(80)) + passage + text(rng.randrange(80))))
    return items, docs + [(200, text(4000)), (201, items[3][1] + text(300) + items[4][1])]


def brute(items, docs):
    known = {}
    for item_id, text in items:
        text = dec.normal_text(text or "")
        if item_id is not None and len(text) >= dec.LEAST_LETTERS:
            known[text] = min(item_id, known.get(text, item_id))
    out = set()
    for doc_id, text in docs:
        for item, item_id in known.items():
            best = min(distances(item, dec.normal_text(text or "")))
            if best <= int(dec.RATE * len(item)):
                out.add((doc_id, item_id, best))
    return out


def test_against_all_distances(spark, world, monkeypatch):
    items, docs = world
    want = brute(items, docs)
    assert {b for _, _, b in want} > {0, 1, 2, 3} and len({i for i, _, _ in want}) < len(docs)
    frame = documents(spark, docs)
    for size in (dec.BLOCK_BYTES, 500):  # one block, and many
        monkeypatch.setattr(dec, "BLOCK_BYTES", size)
        rows = dec.find_items(frame, benchmark(spark, items)).collect()
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in rows} == want and len(rows) == len(want)
        kept = dec.without_items(frame, benchmark(spark, items))
        assert kept.columns == frame.columns
        assert {i for i, _ in pairs(kept)} == {i for i, _ in docs} - {i for i, _, _ in want}
    texts = dict(docs)
    by_id = {i: dec.normal_text(t) for i, t in items if t}
    for row in rows:
        raw = np.frombuffer(texts[row["doc_id"]][row["start"] : row["stop"]].encode(), np.uint8)
        passage = dec.normal(raw, np.array([0, len(raw)]))[0].tobytes().decode()
        assert distances(by_id[row["item_id"]], passage)[-1] <= row["distance"]


def test_myers_against_the_table():
    rng = random.Random(3)
    for _ in range(150):
        item = "".join(rng.choice("abé") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abé") for _ in range(rng.randint(0, 120)))
        assert list(dec.Pattern(item).distances(text)) == distances(item, text)[1:]
        whole = list(range(1, len(text) + 1))
        for j in range(len(text)):
            row = list(range(j + 2))
            for i, a in enumerate(item, 1):
                after = [i]
                for k in range(1, j + 2):
                    after.append(min(row[k] + 1, after[-1] + 1, row[k - 1] + (a != text[k - 1])))
                row = after
            whole[j] = row[-1]
            if j > 12:
                break
        assert list(dec.Pattern(item).distances(text, anchored=True))[: min(len(text), 14)] == whole[: min(len(text), 14)]


def test_frames(spark):
    docs = odd_documents(spark)
    items = benchmark(spark, [(1, "token = \"0CAB398dc11d1a2a11dc6572c8df8bd2\""), (2, "word word  word\nword word"), (3, None)])
    found = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in dec.find_items(docs, items).collect()), key=repr)
    assert found == [(13, 1, 0), (6, 2, 0), (6, 2, 0)]
    kept = dec.without_items(docs, items)
    assert kept.columns == docs.columns and kept.count() == 15
    assert dec.find_items(docs.limit(0), items).collect() == []
    assert dec.find_items(docs, items.limit(0)).collect() == [] and dec.without_items(docs, items.limit(0)).count() == 18


def test_short_items_and_items_without_an_id(spark):
    """Short items are found unchanged between borders of words; items without an id are searched like others."""
    items = [(1, "What is 12 + 30?"), (2, " Is  it é? "), (None, "abc"), (None, "a longer item that has no id at all"), (3, "  "), (4, "ab")]
    docs = [
        (10, "so: WHAT is\n12 + 30? 42"), (11, "what is 12 + 31?"), (12, "is it é?"), (13, "xis it é?"), (14, "is it é?x"), (15, "(abc)"),
        (16, "abcd 1abc éabc abcé"), (17, "here a longer item that has no ID at al l"), (18, None), (19, ""), (20, "cab abc"), (15, "(abc)"),
    ]
    frame = documents(spark, docs)
    found = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in dec.find_items(frame, benchmark(spark, items)).collect()), key=repr)
    assert found == [(10, 1, 0), (12, 2, 0), (15, None, 0), (15, None, 0), (17, None, 1), (20, None, 0)]
    kept = dec.without_items(frame, benchmark(spark, items))
    assert sorted(i for i, _ in pairs(kept)) == [11, 13, 14, 16, 18, 19]
