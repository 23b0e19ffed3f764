"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are dealt into blocks of their source, about ``BLOCK_DOCS`` each, by a hash of the document. A source's target in
words is so many whole rounds over all its blocks, a last round over some, and one block of which only some documents
are taken, so that the words come as near to the target as that block's documents allow. That fixes how many blocks each
source gives.

The output is a row of shards. A tree over them splits those quotas: each node deals the blocks that its shards get to its two halves, by
one draw from the multivariate hypergeometric distribution, as if all blocks lay shuffled in a row and were cut in the
middle. So quotas are met exactly, and the shards' shares vary as in a true shuffle. Each round has a permutation
of a source's blocks of its own, an affine map; the shards take disjoint stretches of it, one after the other, and order
their documents by a hash. Any task can reckon the place of any document from the plan: no list of draws is kept, and
what a lost executor did is done again alike.

The driver holds the plan: some numbers per source, and of its cut block the keys of the documents taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from lapstar.llm.common import map_texts, mix
from lapstar.llm.words import SPACE, text_of, word_ranges
from lapstar.session import save

WEIGHTS = (1, 2, 3)
REPEATS = 3
BLOCK_DOCS = 64
CELLS = 1024
SHARD_WORDS = 250_000
MOST_SHARDS = 4096
SHARD, ORDER = "mix_shard", "mix_order"


def targets(words: Sequence[int], weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> list[Fraction]:
    """Words to take of each source: shares of all words by weight (repeating), at most ``repeats`` times a source's
    own; what is above goes to the others by weight, until none is above. Exact."""
    weight = [weights[i % len(weights)] for i in range(len(words))]
    left, shares, out = Fraction(sum(words)), sum(weight), [Fraction(0)] * len(words)
    # In this order a source is at its limit only if all before it are.
    for i in sorted(range(len(words)), key=lambda i: Fraction(repeats * words[i], weight[i])):
        out[i] = min(Fraction(repeats * words[i]), left * weight[i] / shares)
        left, shares = left - out[i], shares - weight[i]
    return out


@dataclass
class Source:
    """One source's part of the plan."""

    name: str | None
    words: int
    docs: int
    target: Fraction
    blocks: int = 1
    rounds: int = 0
    rest: int = 0  # whole words to take beyond the rounds
    whole: int = 0  # blocks of the last round
    taken: frozenset = field(default_factory=frozenset)  # keys of documents of the block behind them

    def __post_init__(self):
        self.blocks = max(1, -(-self.docs // BLOCK_DOCS))
        if self.words:
            self.rounds = int(self.target // self.words)
            self.rest = int(self.target - self.rounds * self.words)

    def draws(self) -> int:
        """Blocks it gives, repeats and the cut one counted."""
        return self.rounds * self.blocks + self.whole + bool(self.taken) if self.words else 0

    def places(self, block: np.ndarray, round_: int, seed: int) -> np.ndarray:
        """The places of blocks in the order of a round."""
        rng = np.random.default_rng([seed, round_, self.blocks, len(self.name or ""), *(self.name or "").encode()])
        factor = int(rng.integers(1, max(2, self.blocks)))
        while gcd(factor, self.blocks) > 1:
            factor += 1
        return (block * factor + int(rng.integers(self.blocks))) % self.blocks


@lru_cache(maxsize=2)
def quotas(draws: tuple[int, ...], shards: int, seed: int) -> np.ndarray:
    """How many blocks of each source each shard gets, one row per shard, by the splitting tree."""
    out = np.zeros((shards, len(draws)), np.int64)
    total = sum(draws)
    stack = [(0, shards, np.array(draws, np.int64))]
    while stack:
        low, high, own = stack.pop()
        if high - low == 1:
            out[low] = own
            continue
        middle = (low + high) // 2
        size = total * middle // shards - total * low // shards
        rng = np.random.default_rng([seed, shards, low, high])
        left = rng.multivariate_hypergeometric(own, size, method="marginals") if own.sum() else own
        stack += [(low, middle, left), (middle, high, own - left)]
    return out


@dataclass
class Plan:
    """What every task needs to know: the sources in order, the number of shards, and the seed."""

    sources: list[Source]
    shards: int
    seed: int

    def numbers(self, names: pa.Array) -> np.ndarray:
        """The number of each row's source."""
        number = {x.name: i for i, x in enumerate(self.sources)}
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        coded = names.dictionary_encode(null_encoding="encode")
        known = np.array([number[x] for x in coded.dictionary.to_pylist()] or [0], np.int64)
        return known[coded.indices.to_numpy(zero_copy_only=False)]

    def blocks(self, source: np.ndarray, key: np.ndarray) -> np.ndarray:
        n = np.array([x.blocks for x in self.sources], np.uint64)
        return (key.view(np.uint64) % n[source]).astype(np.int64)

    def draws(self, source: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all draws of some documents: the document, its shard, and its place among the shard's documents."""
        block = self.blocks(source, key)
        bounds = np.cumsum(quotas(tuple(x.draws() for x in self.sources), self.shards, self.seed), axis=0)
        found = []
        for i in np.unique(source).tolist():
            own, rows = self.sources[i], np.flatnonzero(source == i)
            for round_ in range(own.rounds + bool(own.whole or own.taken)):
                at = own.places(block[rows], round_, self.seed)
                drawn = np.ones(len(rows), bool)
                if round_ == own.rounds:
                    drawn = at < own.whole
                    for j in np.flatnonzero(at == own.whole).tolist():
                        drawn[j] = int(key[rows[j]]) in own.taken
                at = round_ * own.blocks + at[drawn]
                shard = np.searchsorted(bounds[:, i], at, "right")
                salt = mix(np.array([self.seed * 8 + round_], np.uint64))
                found.append((rows[drawn], shard, mix(key[rows[drawn]].view(np.uint64) ^ salt).view(np.int64)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _key(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def sized(docs: DataFrame, seed: int, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, key, size`` of every row: its words, and a hash by which it is dealt."""

    def count(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        starts, _ = word_ranges(offsets, ~SPACE[data])
        return {"size": pa.array(np.bincount(text_of(offsets, starts), minlength=len(offsets) - 1))}

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        _key("doc_id", text_col, seed).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return map_texts(rows, count, "doc_id long, source string, key long, size long", keep=("doc_id", "source", "key"))


def _last_round(rows: DataFrame, made: Plan) -> None:
    """Fills in how far each source's last round goes: whole blocks, then documents of the next one."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.array([x.rest for x in made.sources], np.int64)
        for batch in batches:
            source, key = made.numbers(batch.column("source")), batch.column("key").to_numpy()
            block, at = made.blocks(source, key), np.zeros(len(key), np.int64)
            for i in np.unique(source).tolist():
                own = source == i
                at[own] = made.sources[i].places(block[own], made.sources[i].rounds, made.seed)
            cell = at * CELLS // np.array([x.blocks for x in made.sources], np.int64)[source]
            table = pa.RecordBatch.from_pydict({
                "source": pa.array(source), "rest": pa.array(rest[source]), "cell": pa.array(cell), "at": pa.array(at),
                "key": pa.array(key), "size": batch.column("size"),
            })
            yield table.filter(pa.array(rest[source] > 0))

    schema = "source long, rest long, cell long, at long, key long, size long"
    placed = rows.mapInArrow(places, schema)
    blocks = save(placed.groupBy("source", "rest", "cell", "at").agg(F.sum("size").alias("size")), "blocks")
    cells = blocks.groupBy("source", "rest", "cell").agg(F.sum("size").alias("size"))
    along = Window.partitionBy("source").orderBy("cell")  # CELLS rows a source at most
    cells = cells.withColumn("end", F.sum("size").over(along)).withColumn("start", F.col("end") - F.col("size"))
    edge = save(cells.filter("start <= rest and rest < end").select("source", "cell", "start"), "edge")
    inside = blocks.join(edge, ["source", "cell"])
    along = Window.partitionBy("source").orderBy("at")  # the blocks of one cell
    inside = inside.withColumn("end", F.col("start") + F.sum("size").over(along))
    inside = inside.withColumn("start", F.col("end") - F.col("size")).filter("start <= rest and rest < end")
    for row in inside.select("source", "at", "start").collect():  # one a source
        made.sources[row["source"]].whole = row["at"]
        made.sources[row["source"]].rest -= row["start"]
    cut = np.array([x.whole if x.rest else -1 for x in made.sources], np.int64)

    def of_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(batch.column("at").to_numpy() == cut[batch.column("source").to_numpy()]))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        left = made.sources[int(rows["source"].iloc[0])].rest
        rows = rows.iloc[np.argsort(mix(rows["key"].to_numpy().view(np.uint64)), kind="stable")]
        taken, others = [], []
        for key, size in zip(rows["key"].tolist(), rows["size"].tolist(), strict=True):
            if size <= left:
                taken, left = [*taken, key], left - size
            else:
                others.append((size, key))
        if others and min(others)[0] - left < left:
            taken.append(min(others)[1])
        return pd.DataFrame({"source": rows["source"].iloc[0], "key": taken}, columns=["source", "key"])

    # Rows of one document and text are drawn alike.
    some = placed.mapInArrow(of_cut, schema).groupBy("source", "key").agg(F.sum("size").alias("size"))
    taken: dict[int, set[int]] = {}
    for row in some.groupBy("source").applyInPandas(fit, "source long, key long").collect():  # part of a block a source
        taken.setdefault(row["source"], set()).add(row["key"])
    for number, keys in taken.items():
        made.sources[number].taken = frozenset(keys)


def plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, seed: int = 0, shards: int | None = None) -> Plan:
    """The plan of a mix of a stored table of ``sized`` rows. Sources are in order of code points, null last."""
    found = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goals = targets([r["words"] for r in found], weights, repeats)
    made = Plan([Source(r["source"], r["words"], r["docs"], t) for r, t in zip(found, goals, strict=True)], 1, seed)
    total = sum(x.words for x in made.sources)
    made.shards = shards or min(MOST_SHARDS, max(1, -(-total // SHARD_WORDS)))
    if any(x.rest for x in made.sources):
        _last_round(rows, made)
    return made


def summary(docs: DataFrame, seed: int, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, size, source_size, target, taken, draws`` of every row of ``docs``, from its draws for the mix.

    Size is in words; a null or empty text has none, and is drawn with its block. A null source is a source of its own, the last one;
    a source without words has target 0. Repeated rows (same id and text) are drawn alike. Null ids are ids like
    others. No rows: none. Other columns are left out.
    """
    rows = save(sized(docs, seed), "sized")
    made = plan(rows, weights, repeats, seed)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.array([x.words for x in made.sources] or [0], np.int64)
        goal = np.array([float(x.target) for x in made.sources] or [0.0])
        for batch in batches:
            source, size = made.numbers(batch.column("source")), batch.column("size").to_numpy()
            row, _, _ = made.draws(source, batch.column("key").to_numpy())
            draws = np.bincount(row, minlength=len(batch))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "size": pa.array(size), "source_size": pa.array(words[source]),
                "target": pa.array(goal[source]), "taken": pa.array(size * draws), "draws": pa.array(draws.astype(np.int32)),
            })

    return rows.mapInArrow(draw, "doc_id long, size long, source_size long, target double, taken long, draws int")


def mixed(docs: DataFrame, made: Plan, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: each row of ``docs`` with all its columns, once per draw, with its shard (``mix_shard``) and a number by
    which the shard's rows are ordered (``mix_order``). Columns of these names must not exist."""
    if {SHARD, ORDER} & set(docs.columns):
        raise ValueError(f"columns {SHARD} and {ORDER} are made here")
    kept = docs.columns
    names = [f"c{i}" for i in range(len(kept))]
    extra = [_key("doc_id", text_col, made.seed).alias("key"), F.col(source_col).cast("string").alias("source")]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], *extra)
    added = [StructField(SHARD, LongType()), StructField(ORDER, LongType())]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shard, order = made.draws(made.numbers(batch.column("source")), batch.column("key").to_numpy())
            drawn = batch.select(names).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*drawn.columns, pa.array(shard), pa.array(order)], [*names, SHARD, ORDER])

    schema = StructType([*(StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)), *added])
    return rows.mapInArrow(draw, schema).toDF(*kept, SHARD, ORDER)


def write(docs: DataFrame, path: str, seed: int, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> Plan:
    """Writes the mix as Parquet, a folder per shard, its rows in their order; texts are moved once."""
    made = plan(save(sized(docs, seed), "sized"), weights, repeats, seed)
    rows = mixed(docs, made).repartition(min(made.shards, 10_000), SHARD).sortWithinPartitions(SHARD, ORDER)
    rows.write.partitionBy(SHARD).parquet(path)
    return made
