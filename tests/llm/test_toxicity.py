import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, odd_documents

from lapstar.llm import toxicity
from lapstar.llm.common import utf8
from lapstar.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def features(texts):
    data, offsets = utf8(pa.array(texts))
    text, bucket, weight = toxicity.terms(data, offsets)
    return [(bucket[text == i], weight[text == i]) for i in range(len(texts))]


def test_terms_of_a_text():
    (bucket, weight), (none, _) = features(["Insult insult other", " .,"])
    assert len(none) == 0
    words = {"insult": 2, "other": 1}
    assert len(bucket) == sum(1 + sum(len(w) > n for n in toxicity.PREFIXES) for w in words)
    assert np.isclose(weight.max(), (1 + np.log(2)) / 3**0.25) and np.isclose(weight.min(), 1 / 3**0.25)


def test_pairs_mean_more_than_their_parts():
    """Toxic only if both an insult and a group are there: no weights per term can tell."""
    rng = np.random.default_rng(3)
    filler = [f"word{i}" for i in range(30)]
    texts, labels = [], []
    for i in range(600):
        insult, group = i % 2, i // 2 % 2
        words = [*rng.choice(filler, 5), *["grobian"] * insult, *["others"] * group]
        texts.append(" ".join(rng.permutation(words)))
        labels.append(int(insult == group))
    labels = np.array(labels, float)
    old = toxicity.LEAST_Z
    toxicity.LEAST_Z = 0
    try:
        model = toxicity.fit(features(texts[:400]), labels[:400])
    finally:
        toxicity.LEAST_Z = old
    data, offsets = utf8(pa.array(texts[400:]))
    scores = model.scores(*toxicity.terms(data, offsets, model.numbers()), 200)
    assert ((scores > 0.5) == labels[400:]).mean() > 0.95
    # The pair sum is the sum over pairs.
    term, weight = np.array([0, 1, 2]), np.array([0.5, 1.5, 2.0])
    whole = model.bias + model.weights[term] @ weight + sum(
        model.factors[i] @ model.factors[j] * weight[i] * weight[j] for i in range(3) for j in range(i)
    )
    assert np.isclose(model.scores(np.zeros(3, int), term, weight, 1)[0], 1 / (1 + np.exp(-whole)))


@pytest.fixture(scope="module")
def scored(spark):
    found = QUERIES["op2_toxicity"](spark, SF)
    return found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()


def test_held_out_accuracy(scored):
    assert len(scored) == 1000
    for row in scored:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert row["predicted"] == int(row["score"] >= 0.7) and 0 <= row["score"] <= 1
    known = [r for r in scored if r["toxic"] is not None and r["held_out"]]
    toxic = [r for r in known if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.7 * len(toxic)
    assert sum(r["predicted"] for r in known) - sum(r["predicted"] for r in toxic) <= 0.02 * len(known)


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, "you loser idiot" if i % 4 == 0 else f"calm words number {i}") for i in range(120)]
    docs = documents(spark, rows)
    for flip in (False, True):
        labels = [(i, int((i % 4 == 0) != (flip and zlib.crc32(str(i).encode()) % 3 == 1))) for i, _ in rows]
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
        if flip:
            assert found == before
        before = found
    assert all((s >= 0.7) == (i % 4 == 0) for i, s in found.items())
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i % 4}


def test_frames(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(0, None), (4, 1), (4, 0), (5, 1), (5, 1), (9, 0), (None, 1), (77, 0)], "doc_id long, toxic int"
    )
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 18 and all(0 <= r["score"] <= 1 for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (0, 1, 2, 3)}
    assert len(same) == 1
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).collect() == []
    nobody = toxicity.train(docs.limit(0), labels)
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, nobody).collect())


def test_pairs_are_learnt_with_the_settings_of_production():
    """An insult and a group, each as common in both classes, that are toxic only together."""
    rng = np.random.default_rng(3)
    filler = [f"word{i}" for i in range(30)]
    texts = [
        " ".join(rng.permutation([*rng.choice(filler, 5), *["grobian"] * (i % 2), *["others"] * (i // 2 % 2)]))
        for i in range(600)
    ]
    labels = np.array([i % 2 == i // 2 % 2 for i in range(600)], float)
    model = toxicity.fit(features(texts[:400]), labels[:400])
    data, offsets = utf8(pa.array(texts[400:]))
    scores = model.scores(*toxicity.terms(data, offsets, model.numbers()), 200)
    assert ((scores > 0.5) == labels[400:]).mean() > 0.95


def test_rare_insults_are_learnt():
    """One insult in 592 of 600 toxic texts, another in the eight that are left."""
    rng = np.random.default_rng(5)
    filler = [f"word{i}" for i in range(800)]
    texts = []
    for i in range(1500):
        insult = ["halunke" if i < 16 or i >= 1200 else "grobian"] * (i % 2)
        texts.append(" ".join(rng.permutation([*rng.choice(filler, 30), *insult])))
    model = toxicity.fit(features(texts[:1200]), np.arange(1200) % 2.0)
    data, offsets = utf8(pa.array(texts[1200:]))
    scores = model.scores(*toxicity.terms(data, offsets, model.numbers()), 300)
    assert ((scores > 0.5) == np.arange(300) % 2).mean() > 0.95
