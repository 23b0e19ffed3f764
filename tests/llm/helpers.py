"""Small frames of documents that every operator has to take."""

import math

ODD_TEXTS = [
    None, "", " ", "\n\t \r", "a", "A b", "word " * 3000, "x" * 5000, "éßñ 日本語 \U0001f642 é",
    "The same text, twice.", "The same text, twice.", "\x00\x01\x7f", "<|endoftext|> <s> ▁ ▁▁",
    "token = \"0cab398dc11d1a2a11dc6572c8df8bd2\"",
]


def odd_documents(spark, ids=None):
    """Nulls, empty and long texts, repeated rows, a null id, and columns whose names operators use themselves."""
    rows = [(i, text) for i, text in enumerate(ODD_TEXTS)] + [(3, ODD_TEXTS[3]), (6, ODD_TEXTS[6]), (None, "A b"), (None, None)]
    names = "rid long, n long, score double, ids string, kept string, key string, part string, size long, bands string"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {names}"
    return spark.createDataFrame(
        [(i, t, None, "s", None if t is None else len(t), 1, None, math.nan, "x", None, "k", "p", 0, "b") for i, t in rows], schema
    )


def documents(spark, rows):
    """Documents with all columns of the table, from ids and texts."""
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )


def pairs(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()), key=repr)


def thue_morse(n):
    """A word of ``n`` letters a and b, and the one with both exchanged."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))
