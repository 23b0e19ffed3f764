import re

import numpy as np
import pytest
from helpers import documents, odd_documents, pairs, thue_morse
from pyspark.sql import functions as F

from lapstar.llm import nearcopies, superminhash
from lapstar.llm.common import mix
from lapstar.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, link=85):
    """All pairs, then components."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= link * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = min(ids) if ids and sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in nearcopies.group(frame).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"new{rng.integers(10**9)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    """Families of near copies around a text that is missing or not, copies, chains, a passage that many texts share."""
    rng = np.random.default_rng(11)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts = []
    for size, base_in in ((30, True), (30, False), (12, True)):
        base = word(160)
        texts += [" ".join(edited(rng, base, rng.integers(1, 6))) for _ in range(size)]
        texts += [" ".join(base).upper()] * (2 * base_in)
    chain = word(120)
    for _ in range(8):  # each is like the next, the first unlike the last
        texts.append(" ".join(chain))
        chain = [*chain[8:], *word(8)]
    passage = word(60)
    texts += [" ".join([*word(40), *passage, *word(30)]) for _ in range(25)]
    texts += [" ".join(word(n)) for n in (1, 2, 4, 5, 6, 300)] + ["a b c d", "A  B\tc D", "a b c", None, "", " \n"]
    ids = rng.permutation(len(texts)) * 3 + 1
    return [(int(i), t) for i, t in zip(ids, texts, strict=True)]


def test_against_all_pairs(spark, corpus):
    assert found(documents(spark, corpus)) == brute(corpus)


def test_blocks_and_one_of_each(spark, corpus, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK", 4)
    docs = documents(spark, corpus)
    want = brute(corpus)
    assert found(docs) == want
    kept = nearcopies.one_of_each(docs.union(docs.limit(40)))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in want if r[3])


def test_threshold_is_the_callers(spark):
    """Sets of 96 shingles with 86 in common have a similarity of 0.81: a link from 0.8, none from 0.85."""
    words = [f"w{i}" for i in range(100)]
    docs = documents(spark, [(1, " ".join(words)), (2, " ".join([*words[10:], *[f"v{i}" for i in range(10)]]))])
    assert [r["kept"] for r in nearcopies.group(docs, link=85).collect()] == [True, True]
    assert [r["doc_id"] for r in nearcopies.one_of_each(docs, link=80).collect()] == [1]
    assert nearcopies.one_of_each(docs, link=85).count() == 2


def test_least_slots_miss_few():
    from math import comb

    for link in (80, 85):
        least, share = nearcopies.least_slots(link), link / 100
        below = [comb(96, n) * share**n * (1 - share) ** (96 - n) for n in range(least + 1)]
        assert sum(below[:-1]) < 1e-9 <= sum(below)


def test_frames(spark):
    docs = odd_documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    have = found(docs)
    assert len(have) == 18
    for doc_id, n, component, kept in brute(rows):
        if doc_id is not None:
            assert (doc_id, n, component, kept) in have
    assert (None, 1, 5, False) in have and (None, 0, None, True) in have
    assert found(docs.limit(0)) == []
    left = nearcopies.one_of_each(docs)
    assert left.columns == docs.columns
    assert [i for i, _ in pairs(left) if i is not None].count(3) == 1


def brute_signature(members, slots):
    row = [2**64 - 1] * slots
    for member in members:
        order = list(range(slots))
        for rank in range(slots):
            value, place = superminhash._draw(np.array([member], np.uint64), rank, slots)
            order[rank], order[int(place[0])] = order[int(place[0])], order[rank]
            row[order[rank]] = min(row[order[rank]], int(value[0]))
    return row


def test_signatures():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 2, 7, 40, 400)]
    rows = superminhash.signatures(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 16)
    assert [list(map(int, r)) for r in rows] == [brute_signature(s, 16) for s in sets]
    shares = []
    for k in range(200):
        both = mix(np.arange(k * 1000, k * 1000 + 460, dtype=np.uint64))
        pair = np.concatenate([both[:430], both[30:]])
        a, b = superminhash.signatures(pair, np.array([0, 430, 860]), 96)
        shares.append((a == b).mean())
    similarity = 400 / 460
    assert abs(np.mean(shares) - similarity) < 0.01
    assert np.std(shares) < np.sqrt(similarity * (1 - similarity) / 96)  # less than of independent values


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5001 + i) for i in range(100)] + [(7, 7), (2, 1), (1, 2)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert len(rows) == len({r["node"] for r in rows})
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_long_words_of_a_regular_build(spark):
    docs = []
    for n in (1024, 4096):
        a, b = thue_morse(n)
        docs += [a, b, f"v w x y {a}", f"v w x y {b}", a]
    rows = list(enumerate(docs))
    assert found(documents(spark, rows)) == brute(rows)
    assert len({r[2] for r in brute(rows)}) == 8


def test_one_id_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, b + " z"), (3, c), (3, c + " z"), (4, None), (4, c), (5, ""), (5, None), (None, a), (0, a + " z")]
    docs = documents(spark, rows)
    left = sorted((r["doc_id"], r["text"]) for r in nearcopies.one_of_each(docs).filter("doc_id is not null").collect() if r["text"])
    assert left[0] == (0, a + " z") and left[1] == (1, b) and len(left) == 3 and left[2][0] == 3
    empty = [r["doc_id"] for r in nearcopies.one_of_each(docs).collect() if not r["text"]]
    assert sorted(empty) == [4, 5]
    assert nearcopies.one_of_each(docs).filter("doc_id is null").count() == 1
    shuffled = nearcopies.one_of_each(docs.repartition(5)).filter("text <> '' and doc_id is not null")
    assert sorted((r["doc_id"], r["text"]) for r in shuffled.collect()) == left


def test_one_odd_class_in_a_large_hub(spark, monkeypatch):
    """It is compared with every member, in rows that grow with the group and not with its square."""
    size = 20_000
    members = spark.range(size + 1).select(F.lit(0).cast("long").alias("hub"), F.col("id").alias("cid"), F.lit(50).cast("long").alias("n"))
    known = spark.range(size).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("component"))
    rows = nearcopies._paired_blocks(members, known)
    blocks = -(-size // nearcopies.BLOCK)
    assert rows.count() == size + blocks + 1  # the odd one in every block, and with itself
    met = rows.groupBy("i", "j").agg(F.max((F.col("cid") == size).cast("int")).alias("odd"), F.count("*").alias("n"))
    assert met.filter("odd = 1").agg(F.sum("n")).first()[0] == size + blocks + 1
