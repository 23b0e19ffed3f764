from fractions import Fraction

import numpy as np
import pytest
from helpers import odd_documents
from pyspark.sql import functions as F

from lapstar.llm import mixing
from lapstar.llm.queries import QUERIES


def plain_targets(words, weights=(1, 2, 3), repeats=3):
    """As the rule is told: share, cut, reshare what is above."""
    weight = [weights[i % len(weights)] for i in range(len(words))]
    out, free, left = [Fraction(0)] * len(words), set(range(len(words))), Fraction(sum(words))
    while free and left:
        total = sum(weight[i] for i in free)
        for i in free:
            out[i] += left * weight[i] / total
        left = Fraction(0)
        for i in list(free):
            if out[i] >= repeats * words[i]:
                left += out[i] - repeats * words[i]
                out[i] = Fraction(repeats * words[i])
                free.remove(i)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    rng = np.random.default_rng(seed)
    words = [int(x) for x in rng.integers(0, 10 ** rng.integers(1, 6), rng.integers(1, 12))]
    found = mixing.targets(words)
    assert found == plain_targets(words)
    assert sum(found) == sum(words) and all(t <= 3 * w for t, w in zip(found, words, strict=True))


def test_quotas_are_exact_and_vary_as_in_a_shuffle():
    draws = (70, 20, 10, 0)
    found = np.array([mixing.quotas(draws, 7, seed) for seed in range(600)])
    assert (found.sum(1) == draws).all()
    assert (found.sum(2) == np.diff([100 * i // 7 for i in range(8)])).all()
    mean = 14 * np.array(draws) / 100
    assert np.abs(found[:, 0].mean(0) - mean).max() < 0.25  # of the first shard: 14 of 100 draws
    variance = 14 * 0.7 * 0.3 * (100 - 14) / 99
    assert abs(found[:, 0, 0].var() / variance - 1) < 0.25 and abs(found[:, 6, 0].var() / (15 * 0.21 * 85 / 99) - 1) < 0.25
    assert mixing.quotas((0, 0), 3, 1).sum() == 0 and mixing.quotas((), 2, 1).shape == (2, 0)


def corpus(spark, n=3000):
    rng = np.random.default_rng(5)
    names = ["a", "b", "é", "\U0001f642", "c", None]
    share = np.array([0.4, 0.2, 0.2, 0.1, 0.09, 0.01])
    rows = [(i, "w " * int(rng.lognormal(3, 1.2)), "en", names[rng.choice(6, p=share)], 1) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows


def check(found, rows):
    """Every column but ``taken`` by hand; ``taken`` whole texts, three at most, near the target."""
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    names = sorted({r[3] for r in rows}, key=lambda x: (x is None, x or ""))
    words = [sum(size[r[0]] for r in rows if r[3] == name) for name in names]
    goal = dict(zip(names, plain_targets(words), strict=True))
    source = {r[0]: r[3] for r in rows}
    assert sorted(r["doc_id"] for r in found) == sorted(size)
    got = dict.fromkeys(names, 0)
    for r in found:
        name = source[r["doc_id"]]
        assert (r["size"], r["source_size"], r["target"]) == (size[r["doc_id"]], words[names.index(name)], float(goal[name]))
        assert r["taken"] == r["draws"] * r["size"] and 0 <= r["draws"] <= 3
        assert r["draws"] in (int(goal[name] // max(1, r["source_size"])), int(goal[name] // max(1, r["source_size"])) + 1)
        got[name] += r["taken"]
    for name in names:
        least = min((size[i] for i in source if source[i] == name and size[i]), default=0)
        assert abs(got[name] - goal[name]) <= max(least, 0.01 * goal[name]), name


def test_summary(spark):
    docs, rows = corpus(spark)
    found = mixing.summary(docs.repartition(7), 3).collect()
    check(found, rows)
    again = mixing.summary(docs.repartition(2), 3).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    other = mixing.summary(docs, 4).collect()
    assert sorted(map(tuple, found)) != sorted(map(tuple, other))


def test_query(spark):
    directory = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    check(QUERIES["op13_mix"](spark, directory).collect(), [(i, " ".join(__import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")), x, s) for i, t, x, s in rows])


def test_the_mix(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 9000)
    docs, rows = corpus(spark, 2000)
    made = mixing.write(docs, str(tmp_path / "mix"), 3)
    assert made.shards > 5
    found = spark.read.parquet(str(tmp_path / "mix"))
    taken = {r["doc_id"]: r["draws"] for r in mixing.summary(docs, 3).collect() if r["draws"]}
    assert {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()} == taken
    assert {r["doc_id"]: r["text"] for r in found.select("doc_id", "text").distinct().collect()} == {i: rows[i][1] for i in taken}
    # Each shard has the quota of blocks of each source.
    want = mixing.quotas(tuple(x.draws() for x in made.sources), made.shards, 3)
    got = np.zeros_like(want)
    for r in found.groupBy("mix_shard", "source").agg(F.collect_list(F.struct("doc_id", "text")).alias("rows")).collect():
        i = [x.name for x in made.sources].index(r["source"])
        keys = spark.createDataFrame(r["rows"], "doc_id long, text string").select(mixing._key("doc_id", "text", 3)).toPandas().iloc[:, 0]
        got[r["mix_shard"], i] = len(set(made.blocks(np.full(len(keys), i), keys.to_numpy()).tolist()))
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()  # a block may come twice to a shard, or be empty
    words = {r["mix_shard"]: r["w"] for r in found.groupBy("mix_shard").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("w")).collect()}
    assert len(words) == made.shards
    order = [r["mix_order"] for r in found.filter("mix_shard = 0").collect()]
    assert len(set(order)) == len(order)


def test_odd_tables(spark):
    docs = odd_documents(spark)
    found = mixing.summary(docs, 1).collect()
    assert len(found) == docs.count()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in docs.collect()}
    assert {r["target"] for r in found} == {float(found[0]["source_size"])} and all(r["draws"] == 1 for r in found)
    assert mixing.summary(docs.limit(0), 1).collect() == []
    empty = mixing.summary(docs.withColumn("text", F.lit(None).cast("string")), 1).collect()
    assert all((r["size"], r["source_size"], r["target"], r["taken"]) == (0, 0, 0.0, 0) for r in empty) and len(empty) == len(found)
    with pytest.raises(ValueError, match="mix_shard"):
        mixing.mixed(docs.withColumn("mix_shard", F.lit(1)), None)
