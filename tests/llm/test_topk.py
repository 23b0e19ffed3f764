import numpy as np
import pytest
from pyspark.sql import functions as F

from lapstar.llm import topk


def brute(queries, rows, k):
    out = []
    for own, query in queries:
        scores = [(-int(np.dot(query, row)), i) for i, row in rows if i != own and len(row) == len(query)]
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "vec_id long, vector array<double>")


@pytest.mark.parametrize("seed", range(3))
def test_against_all_scores(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.integers(-4, 5, 6)) for i in rng.permutation(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # one very common vector
    rows += [(2000, np.zeros(6, int)), (2001, rng.integers(0, 3, 4)), (2002, rng.integers(0, 3, 4))]
    queries = rows[:20] + rows[-3:]
    found = topk.search(frame(spark, queries), frame(spark, rows), 9)
    assert sorted(tuple(r) for r in found.collect()) == brute(queries, rows, 9)


def test_stops_early():
    rng = np.random.default_rng(1)
    rows = np.round(rng.normal(0, 20, (4000, 8)))
    rows[:, 0] += np.where(np.arange(4000) < 30, 900, 0)
    lists, stats = topk.Lists(np.arange(4000), rows), {}
    query = np.array([50, 1, 0, 0, -1, 0, 0, 0.0])
    ids, scores = lists.best(query, -1, 10, stats)
    want = np.lexsort((np.arange(4000), -(rows @ query)))[:10]
    assert ids.tolist() == want.tolist() and scores.tolist() == (rows @ query)[want].tolist()
    assert stats["scored"] < 1000


def test_whole_components(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.5, -0.01, 1.0], None, [1.0, None], [nan, 1.0], [inf], [-inf, 0.0], [], [0.999999, -1.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "i int, v array<float>")
    found = {r["i"]: r["w"] for r in df.select("i", topk.whole(F.col("v")).alias("w")).collect()}
    assert found == {0: [32.0, -1.0, 64.0], 1: None, 2: None, 3: None, 4: None, 5: None, 6: [], 7: [63.0, -64.0]}


def test_frames(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (1, None), (None, [5, 5]), (2, [1, 1]), (2, [1, 1]), (3, [0, 0]), (4, [])]
    df = frame(spark, rows).withColumn("rank", F.lit(7)).withColumn("score", F.lit("x")).withColumn("c", F.lit(1))
    found = sorted(tuple(r) for r in topk.search(df.filter("vec_id in (0, 1, 4)"), df, 3).collect())
    assert found == [(0, 1, 2, 3), (0, 2, 2, 3), (0, 3, 3, 0)]
    assert topk.search(df, df.limit(0), 3).collect() == [] == topk.search(df.limit(0), df, 3).collect()


def test_large_numbers(spark):
    rows = [(0, [2.0**30, 3]), (1, [2.0**30, 1]), (2, [2.0**30 - 1, 5])]
    found = topk.search(frame(spark, rows[:1]), frame(spark, rows), 2).collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 2**60 + 3), (2, 2**60 - 2**30 + 15)]
    with pytest.raises(Exception, match="64 bits"):
        topk.search(frame(spark, [(0, [2.0**40])]), frame(spark, [(1, [2.0**40])]), 1).collect()
