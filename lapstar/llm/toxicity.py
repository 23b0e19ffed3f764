"""Toxicity score: a factorisation machine over hashed terms.

A text's terms are its words and their first bytes of a few lengths, hashed into buckets; a term's weight is
``(1 + ln count) / words ** 0.25``. The score is the logistic function of a bias, a weight per term, and a product of
short vectors per pair of terms, so that two terms may mean together what neither does alone. The pair sum over all
terms of a text costs as much as a few plain sums.

The model learns from a bounded sample of labelled texts, up to ``SAMPLE`` of each class, chosen by a hash of the id;
their terms are extracted on the executors, and one task learns from them. All terms of ``LEAST_TEXTS`` texts or more are learnt, in two turns. The
first turn has only the ``FIRST_TERMS`` terms whose presence differs most between the classes of the sample, by
``LEAST_Z`` standard errors at least. The second has all terms, with an L1 penalty of half a standard error on the weights of
the others, so that they learn from what the first ones leave unexplained: rare insults, and terms that tell only
together. All texts are scored on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.llm.common import map_texts, ragged, slices, texts_of, utf8
from lapstar.llm.words import LOWER, Ranges, text_of, word_ranges

SAMPLE = 3000
BITS = 21
PREFIXES = (4, 5, 6)
LEAST_TEXTS = 3
LEAST_Z = 4
FIRST_TERMS = 1000
FACTORS = 4
EPOCHS = 40
BATCH = 500
RATE = 0.5
DECAY = 1e-6
PENALTY = 0.5
THRESHOLD = 0.7

WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None):
    """Text number, bucket and weight of each distinct term of each text; only ``wanted`` buckets, if given.

    ``wanted`` maps a bucket to a number from 0 on, or to -1; the numbers are then returned instead.
    """
    data = LOWER[data]
    starts, ends = word_ranges(offsets, WORD[data])
    owner = text_of(offsets, starts)
    n_words = np.bincount(owner, minlength=len(offsets) - 1)
    ranges, keys = Ranges(data), []
    for size in (None, *PREFIXES):
        longer = slice(None) if size is None else ends - starts > size
        begin = starts[longer]
        found = ranges(begin, ends[longer] if size is None else begin + size) >> np.uint64(64 - BITS)
        found = found.astype(np.int64)
        text = owner[longer]
        if wanted is not None:
            found = wanted[found]
            text, found = text[found >= 0], found[found >= 0]
        keys.append((text << BITS) | found)
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    text = key >> BITS
    return text, key & ((1 << BITS) - 1), (1 + np.log(count)) / n_words[text] ** 0.25


@dataclass
class Model:
    """Bias, buckets of the terms it knows, their weights and factors."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def numbers(self) -> np.ndarray:
        """Every bucket's row in the model, or -1."""
        found = np.full(1 << BITS, -1, np.int64)
        found[self.buckets] = np.arange(len(self.buckets))
        return found

    def scores(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        total = np.full(n, self.bias) + np.bincount(text, self.weights[term] * weight, n)
        for f in range(self.factors.shape[1]):
            part = self.factors[term, f] * weight
            total += 0.5 * (np.bincount(text, part, n) ** 2 - np.bincount(text, part**2, n))
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


@dataclass
class Texts:
    """The terms of some texts, one text's after the other's."""

    starts: np.ndarray  # where each text begins; one more entry than texts
    terms: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, texts: list[tuple[np.ndarray, np.ndarray]]) -> Texts:
        starts = np.cumsum([0, *(len(b) for b, _ in texts)])
        return cls(starts, np.concatenate([b for b, _ in texts]), np.concatenate([w for _, w in texts]))

    def only(self, keep: np.ndarray, terms: np.ndarray | None = None) -> Texts:
        """Without some entries; with other names for the terms."""
        kept = np.concatenate([[0], np.cumsum(keep)])[self.starts]
        return Texts(kept, (self.terms if terms is None else terms)[keep], self.weights[keep])

    def some(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text (numbered as in ``chosen``), term and weight of the entries of some texts."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        at = np.repeat(self.starts[chosen], sizes) + ragged(sizes)
        return np.repeat(np.arange(len(chosen)), sizes), self.terms[at], self.weights[at]


def telling_terms(texts: Texts, labels: np.ndarray) -> np.ndarray:
    """The buckets whose share of texts differs most between the classes, by the z value of the difference."""
    both = np.bincount(texts.terms, minlength=1 << BITS)
    toxic = np.bincount(texts.terms[np.repeat(labels > 0, np.diff(texts.starts))], minlength=1 << BITS)
    found = np.flatnonzero(both)
    both, toxic = both[found], toxic[found]
    n, n_toxic = len(labels), labels.sum()
    share = both / n
    gap = np.abs(toxic / n_toxic - (both - toxic) / (n - n_toxic))
    z = gap * np.sqrt(n_toxic * (n - n_toxic) / n / (share * (1 - share) + 1 / n))
    z[both < LEAST_TEXTS] = -1
    chosen = np.argsort(-z, kind="stable")[:FIRST_TERMS]
    return np.sort(found[chosen[z[chosen] >= LEAST_Z]]).astype(np.int64)


def fit(texts: list[tuple[np.ndarray, np.ndarray]] | Texts, labels: np.ndarray, seed: int = 7) -> Model:
    """Learns from (buckets, weights) per text. With one class only, every text gets its score; without any, that of a clean text."""
    if len(np.unique(labels)) < 2:
        none = np.zeros((0, FACTORS))
        return Model(4.0 if labels.sum() else -4.0, np.zeros(0, np.int64), none[:, 0], none)
    texts = texts if isinstance(texts, Texts) else Texts.of(texts)
    buckets = np.flatnonzero(np.bincount(texts.terms, minlength=1 << BITS) >= LEAST_TEXTS)
    first = np.isin(buckets, telling_terms(texts, labels))
    model = Model(0.0, buckets, np.zeros(len(buckets)), np.zeros((len(buckets), FACTORS)))
    rng = np.random.default_rng(seed)
    model.factors = rng.normal(0, 0.01, model.factors.shape)
    at = model.numbers().astype(np.int32)[texts.terms]
    texts = texts.only(at >= 0, at)
    # At most the standard error of the mean gradient of a term that has nothing to do with the label.
    squares = np.bincount(texts.terms, texts.weights**2, len(buckets))
    penalty = PENALTY * np.where(first, 0, 0.5 * np.sqrt(squares) / len(labels))
    sums = [1e-8, np.full(len(buckets), 1e-8), 1e-8]

    def step(value, gradient, k, n):
        """A step down the mean loss. Biases and weights are scaled by their own past gradients, factors by the
        greatest of all factors, so that those of rare terms move little."""
        gradient = gradient / n + DECAY * value
        sums[k] = sums[k] + ((gradient**2).max(initial=0) if k == 2 else gradient**2)
        return value - RATE * gradient / np.sqrt(sums[k])

    turns = [texts.only(first[texts.terms]), texts]
    for epoch in range(2 * EPOCHS):
        rows = turns[epoch // EPOCHS]
        if epoch == EPOCHS:
            sums[2] = 1e-8
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            text, term, weight = rows.some(chosen)
            error = model.scores(text, term, weight, len(chosen)) - labels[chosen]
            spread = error[text] * weight
            size = len(buckets)
            gradients = []
            for f in range(FACTORS):
                part = model.factors[term, f] * weight
                inner = np.bincount(text, part, len(chosen))[text] - part
                gradients.append(np.bincount(term, spread * inner, size))
            model.bias = float(step(model.bias, error.sum(), 0, len(chosen)))
            model.weights = step(model.weights, np.bincount(term, spread, size), 1, len(chosen))
            if epoch >= EPOCHS:
                shrunk = np.abs(model.weights) - RATE * penalty / np.sqrt(sums[1])
                model.weights = np.sign(model.weights) * np.maximum(shrunk, 0)
            model.factors = step(model.factors, np.stack(gradients, 1), 2, len(chosen))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from: a third, by the id alone. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> Model:
    """Learns ``toxic`` from up to ``SAMPLE`` labelled texts of each class that are not held out.

    A text with several labels counts as toxic if one says so; null labels are left out.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = None
    for toxic in (0, 1):
        # Joined by id, so that a sampled label without a text is only lost from the sample.
        part = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = texts_of(docs, text_col=text_col).join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE rows at most

    def extract(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        text, bucket, weight = terms(data, offsets)
        cuts = pa.array(np.searchsorted(text, np.arange(len(offsets))).astype(np.int32))
        return {
            "buckets": pa.ListArray.from_arrays(cuts, pa.array(bucket.astype(np.int32))),
            "weights": pa.ListArray.from_arrays(cuts, pa.array(weight.astype(np.float32))),
        }

    def learn(sample: pa.Table) -> pa.Table:
        sample = sample.take(pa.array(np.argsort(sample["doc_id"].to_numpy(), kind="stable"))).combine_chunks()
        buckets, weights = (sample[name].combine_chunks() for name in ("buckets", "weights"))
        starts = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy())])
        labels = sample["toxic"].to_numpy().astype(np.float64)
        model = fit(Texts(starts, buckets.flatten().to_numpy(), weights.flatten().to_numpy()), labels)
        return pa.table({
            "bias": [model.bias], "buckets": [model.buckets], "weights": [model.weights], "factors": [model.factors.reshape(-1)],
        })

    schema = "doc_id long, toxic int, buckets array<int>, weights array<float>"
    texts = texts.withColumn("toxic", F.col("toxic").cast("int"))
    sample = map_texts(texts, extract, schema, keep=("doc_id", "toxic")).dropDuplicates(["doc_id"])
    # 2 * SAMPLE rows at most are one group: the model is learnt in one task, and only the model goes to the driver.
    learnt = sample.groupBy().applyInArrow(learn, "bias double, buckets array<long>, weights array<double>, factors array<double>")
    row = learnt.toArrow()
    if not len(row):
        return fit([], np.zeros(0))
    buckets, weights, factors = (row[name].combine_chunks().flatten().to_numpy() for name in ("buckets", "weights", "factors"))
    return Model(row["bias"][0].as_py(), buckets, weights, factors.reshape(-1, FACTORS))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts get the score of a text without known terms. Repeated rows are scored each.
    """

    numbers = model.numbers()

    def evaluate(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        text, term, weight = terms(data, offsets, numbers)
        return {"score": pa.array(model.scores(text, term, weight, len(offsets) - 1), pa.float64())}

    found = map_texts(texts_of(docs, text_col=text_col), evaluate, "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``THRESHOLD``.

    Null and empty texts have the score of a text without known terms. Repeated rows stay or go together.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = model.numbers()
        for batch in found:
            data, offsets = utf8(batch.column(text_col))
            for begin, end in slices(offsets):
                part = offsets[begin : end + 1]
                text, term, weight = terms(data[part[0] : part[-1]], part - part[0], numbers)
                scores = model.scores(text, term, weight, end - begin)
                yield batch.slice(begin, end - begin).filter(pa.array(scores < THRESHOLD))

    return docs.mapInArrow(batches, docs.schema)
