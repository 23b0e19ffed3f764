import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_documents

from lapstar.llm import repeats
from lapstar.llm.queries import QUERIES
from lapstar.llm.suffixes import LENGTH, REACH, Buckets, anchors


def brute(texts):
    """Every string of ``LENGTH`` bytes, counted."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + LENGTH] for b in raw for i in range(len(b) - LENGTH + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - LENGTH + 1):
            if count[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts):
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    found = {r["doc_id"]: r for r in repeats.remove_repeats(docs, with_bytes=True).collect()}
    want = brute(texts)
    for i, row in enumerate(want):
        assert tuple(found[i])[1:5] == row, i
        assert hashlib.sha256(found[i]["kept"]).hexdigest() == row[3]
    return want


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    word = lambda n: "".join(rng.choice(list("abcdefg é"), n))
    a, b, c = word(1500), word(399), word(400)
    copy = list(a)
    copy[700] = "X"
    out = [a, a, a[:900], a[500:], "".join(copy), "1" + b + "2", "3" + b + "4", "5" + c + "6", "7" + c + "8", c]
    out += [word(300) + a[k : k + 380 + 5 * k] + word(300) for k in range(12)]  # about the least length
    out += [a[100:520] + a[80:600], word(2000), "", None, "z" * 399, "z" * 400]
    out += ["ab" * 150 + "c" + "ab" * 230, "q" * 401, "r" * 5000, ("xyz" * 200 + "w") * 3]  # runs and periods
    out += [a[200:1000] + word(50) + a[200:1000]]  # inside one text
    out += [x + a[300:1100] + y for x in "abc" for y in ("abc" * 200, "abd" * 200)]
    return out


def test_against_counting(spark, texts):
    want = check(spark, texts)
    assert sum(r[2] for r in want) > 30 and any(r[1] == 0 for r in want)


def test_many_partitions_meet(spark, texts):
    """Runs of equal names that go over the borders of the sorted partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        check(spark, texts + [texts[0]] * 40)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_alphabets(spark):
    rng = np.random.default_rng(9)
    for letters in ("a", "ab"):
        check(spark, ["".join(rng.choice(list(letters), n, p=None)) for n in (390, 400, 401, 470, 900, 1300)])


def test_frames(spark):
    docs = odd_documents(spark)
    found = [tuple(r) for r in repeats.remove_repeats(docs).collect()]
    rows = docs.collect()
    want = [(r["doc_id"], *x) for r, x in zip(rows, brute([r["text"] for r in rows]), strict=True)]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_query(spark, tmp_path):
    """Bytes decide, not words: a passage of over 50 words goes from ``LENGTH`` bytes on. More columns follow the contract's."""
    few, many = (" ".join(f"{name}{i:05d}" for i in range(60))[:size] for name, size in (("f", 399), ("m", 400)))
    texts = [f"{i}{passage}{i}" for passage in (few, many) for i in "12"] + ["alone", None]
    assert len(few.split()) > 50 and len(many.split()) > 50
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op6_repeated_strings"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "has_repeat"]
    want = [(i, *row, int(row[1] > 0)) for i, row in enumerate(brute(texts))]
    assert sorted(tuple(r) for r in found.collect()) == want
    assert [row[2] for row in want] == [0, 0, 400, 400, 0, 0]


def test_every_string_has_an_anchor():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 6000).astype(np.uint8)
    offsets = np.array([0, 100, 100, 1500, 1899, 2299, 6000])
    grams = Buckets(data).grams()
    at, first, last = anchors(grams, offsets)
    owner = {}
    for a, f, e in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
        for begin in range(f, e + 1):
            assert begin not in owner
            owner[begin] = a
    bits = int(len(grams)).bit_length()
    for b, e in zip(offsets[:-1], offsets[1:], strict=True):
        for begin in range(b, e - LENGTH + 1):
            best = min(range(begin, begin + REACH + 1), key=lambda i: (int(grams[i]) >> bits, i))
            assert owner.pop(begin) == best
    assert not owner


def test_names_tell_strings():
    rng = np.random.default_rng(6)
    piece = rng.integers(0, 256, 700).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 256, 333).astype(np.uint8), piece, rng.integers(0, 256, 50).astype(np.uint8), piece])
    buckets = Buckets(data)
    for begin, size in ((0, 64), (5, 100), (9, 127), (0, 128), (3, 400), (1, 515), (0, 700)):
        one, two, other = buckets.names(np.array([333 + begin, 1083 + begin, 334 + begin]), np.array([0, 0, 0]) + size + np.array([333 + begin, 1083 + begin, 334 + begin]))
        assert one == two != other


def test_covered():
    begin, end = repeats.covered(np.array([10, 1, 12, 900]), np.array([11, 1, 20, 900]), 5)
    assert begin.tolist() == [1, 10, 900] and end.tolist() == [6, 25, 905]
    touching = repeats.covered(np.array([0, 5]), np.array([0, 5]), 5)
    assert [x.tolist() for x in touching] == [[0], [10]]


def test_sums_across_chunks(monkeypatch):
    """Ranges of any length have the same hash wherever they lie, with chunks and without."""
    from lapstar.llm import words

    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = rng.integers(0, 3000, 500)
    ends = np.minimum(3000, starts + rng.integers(0, 900, 500))
    whole = words.Ranges(data)(starts, ends)
    grams = words.Ranges(data).windows(64)
    for chunk in (100, 128, 1000, 3000):
        monkeypatch.setattr(words, "CHUNK", chunk)
        assert (words.Ranges(data)(starts, ends) == whole).all() and (words.Ranges(data).windows(64) == grams).all()
        assert len(words.Ranges(data[:10]).windows(64)) == 0
    copied = np.concatenate([data[:5], data, data])
    assert (words.Ranges(copied)(starts + 3005, ends + 3005) == whole).all()
