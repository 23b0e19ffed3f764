import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_documents

from lapstar.llm import collocations


def brute(rows, least=10, subsumed=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {}
    for (lang, *words), a in f.items():
        if len(words) > 1 and a >= least:
            cuts = [(f[lang, *words[:k]], f[lang, *words[k:]]) for k in range(1, len(words))]
            score, k, left, right = min((1000000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            found[lang, *words] = (a, left, right, score)
    out = []
    for lang in n:
        rows = []
        for (own, *words), (a, left, right, score) in found.items():
            inside = [v[0] for key, v in found.items() if key[0] == lang and len(words) == 2 and len(key) == 4
                      and (list(key[1:3]) == words or list(key[2:]) == words)] if own == lang else []
            if own == lang and not any(100 * x >= subsumed * a for x in inside):
                rows.append((-score, -a, " ".join(words).encode(), a, left, right))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.fixture()
def small_parts(monkeypatch):
    monkeypatch.setattr(collocations, "RUN_BYTES", 700)
    monkeypatch.setattr(collocations, "WIDE", 12)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, small_parts, seed):
    rng = random.Random(seed)
    words = ["The", "the", "of", "and", "é", "日本", "x-1", "a\x0bb", "nul\x00", "I'm", "Ünder", *[f"w{i}" for i in range(40)]]
    stops = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", " ; ", "\r\n"]

    def text():
        return "".join(rng.choices(words, [9, 9, 7, 6, 4, 3, 2, 2, 2, 2, 2, *[1] * 40])[0] + rng.choice(stops) for _ in range(rng.choice([0, 3, 40, 160])))

    rows = [(rng.choice(["en", "en", "en", "de", None, "und", ""]), text()) for _ in range(150)]
    rows += [("en", "hot pair hot pair " + " ".join(f"hot u{i} ." for i in range(200)))] * 12  # a wide stripe, repeated rows
    rows += [("en", None), ("xx", ""), ("de", "the the the the the the the the the the the the")]
    found = collocations.mine(frame(spark, rows).repartition(5))
    assert rows_of(found) == brute(rows)
    assert rows_of(collocations.mine(frame(spark, rows), top=7, subsumed=80, least=12)) == brute(rows, 12, 80, 7)


def test_a_wide_stripe_is_cut(spark, small_parts):
    rows = [("en", " . ".join(f"hot u{i}" for i in range(100)))] * 11
    stripes = frame(spark, rows).mapInArrow(
        lambda batches: (run.stripes() for run in collocations._runs(batches)), collocations.STRIPE
    )
    from lapstar.session import save

    found = collocations.merged(save(stripes), 10).filter("prefix = 'hot'").collect()
    assert len(found) > 20 and sum(r["total"] for r in found) == 1100
    assert sorted(x for r in found for x in r["nexts"]) == sorted(f"u{i}" for i in range(100))
    assert all(c == 11 for r in found for c in r["counts"])


def test_the_filter_loses_nothing():
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 2**64, 1000, np.uint64) for _ in range(3)]
    known = np.zeros(1 << collocations.FILTER_BITS - 6, np.uint64)
    for slot in collocations.pair_slots(*own):
        np.bitwise_or.at(known, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
    for slot in collocations.pair_slots(*own):
        assert (known[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).all()


def test_runs_split_batches(monkeypatch):
    monkeypatch.setattr(collocations, "RUN_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 6, "text": ["x y", "", None, "long " * 9, "x y", "x y"]})
    runs = list(collocations._runs(iter([batch, batch.slice(0, 0), batch])))
    assert sum(len(r.unit) for r in runs) == 2 * (2 + 9 + 2 + 2) and len(runs) > 3


def test_odd_tables(spark):
    docs = odd_documents(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert rows_of(collocations.mine(docs)) == brute(rows) != []
    assert rows_of(collocations.mine(docs.limit(0))) == []
    assert rows_of(collocations.mine(docs.filter("text is null"))) == []
    assert [t for _, t in collocations.mine(docs).dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**14, 3 * 10**14, 2 * 10**14), (7, 11, 13)], "a long, l long, r long")
    found = [r[0] for r in df.select(collocations._score("a", "l", "r")).collect()]
    assert found == [1000000 * 10**28 // (6 * 10**28), 1000000 * 49 // 143]
