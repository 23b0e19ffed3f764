"""Cleans a corpus and encodes what stays: five stages, each an operator of ``lapstar.llm``.

Toxic documents go; of each group of near copies one stays; documents that hold a benchmark item go; secrets are
replaced by a mark; the rest is encoded to pieces. Each stage gets what the one before has kept. All but the last
return the columns of the table of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapstar.llm import decontaminate, nearcopies, secrets, sentencepieces, toxicity
from lapstar.llm.queries import SEED, TOKENIZERS, table
from lapstar.session import save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold. Null and empty texts are scored like others; repeated rows share a fate."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of a similarity of 0.8 or more; texts without words stay, and of
    equal rows, or rows of one id without words, one. Rows with a null id stay."""
    return nearcopies.one_of_each(docs, link=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows share a fate."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated rows too, secrets replaced by a mark. A null text stays null."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, lossless`` of every row: pieces with merge-dropout. A null text is empty."""
    return sentencepieces.encoded(docs, f"{TOKENIZERS}/piece_bpe_32k.model", SEED)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("secrets", mask_secrets),
    ("sentencepieces", encode),
]

#: SQL cannot learn a model, so the stages are tested against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the table of documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
