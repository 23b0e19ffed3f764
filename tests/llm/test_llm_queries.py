"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

import duckdb
import pytest
from helpers import documents
from test_decontaminate import brute as leaks
from test_nearcopies import brute as groups

import corpus_pipeline
from lapstar.llm import decontaminate, secrets, toxicity
from lapstar.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def test_one_query_per_operator():
    import __spark_entry__ as entry_point

    names = entry_point.queries()
    for n in range(1, 14):
        assert [x for x in names if x.startswith(f"op{n}_")], n
    assert "pipeline" in names and set(ORACLE) <= set(names)


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    connection = duckdb.connect()
    for x in TABLES:
        connection.execute(f"CREATE VIEW {x} AS SELECT * FROM '{SF}/{x}.parquet'")
    found = QUERIES[name](spark, SF)
    expected = connection.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "benchmark", "secrets", "sentencepieces"]
    found = docs
    for name, stage in corpus_pipeline.STAGES:
        before, found = found, stage(spark, found, SF)
        old = [tuple(r) for r in before.select("doc_id", "text").collect()]
        if name != "sentencepieces":
            assert found.columns == docs.columns
            new = [tuple(r) for r in found.select("doc_id", "text").collect()]
        if name == "toxicity":
            model = toxicity.train(before, table(spark, SF, "labels"))
            clean = {r["doc_id"] for r in toxicity.score(before, model).filter("predicted = 0").collect()}
            assert sorted(new) == sorted(r for r in old if r[0] in clean)
        elif name == "near_copies":
            kept = {r[0] for r in groups(old, 80) if r[3]}
            assert len(kept) < len(old) and sorted(new) == sorted(r for r in old if r[0] in kept)
        elif name == "benchmark":
            items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
            exact = {i for i, t in old if any(decontaminate.normal_text(x) in decontaminate.normal_text(t) for _, x in items)}
            gone = {r[0] for r in old} - {r[0] for r in new}
            assert exact <= gone and sorted(new) == sorted(r for r in old if r[0] not in gone)
            # Whoever shares 16 bytes with an item, as each text with few edits does, or is gone, is held against all distances.
            grams = {x[i : i + 16] for _, t in items for x in [decontaminate.normal_text(t)] for i in range(len(x) - 15)}
            near = [r for r in old if r[0] in gone or any(x[i : i + 16] in grams for x in [decontaminate.normal_text(r[1])] for i in range(len(x) - 15))]
            assert gone == {i for i, _, _ in leaks(items, near[:60])} | (gone - {r[0] for r in near[:60]})
        elif name == "secrets":
            assert sorted(new) == sorted((i, secrets.redacted(t)) for i, t in old)
        else:
            assert found.filter("not lossless").count() == 0 and found.count() == len(old)
        spark.catalog.clearCache()
    assert corpus_pipeline.run(spark, SF).count() == len(old)


def test_stages_take_empty_tables_and_nulls(spark):
    rows = [(1, None), (2, ""), (None, "some words here"), (3, "b " * 4000), (3, "b " * 4000), (4, "b  " * 4000)]
    docs = documents(spark, rows)
    for frame, least in ((docs, 4), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns or name == "sentencepieces"
        assert frame.count() == least
