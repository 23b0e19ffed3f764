"""Near copies: SuperMinHash signatures, banding, exact verification and union-find grouping.

Documents with equal sets of shingles are one class; only classes go on, so copies are never compared. Classes that
agree in all slots of a band share a bucket. Pairs of a bucket are not listed. Instead each bucket has a hub, the class
that meets most others over all bands, and

1. every class is verified against the hubs of its buckets, on full sets; the links found make components;
2. where classes of one hub are still in several components, those of different components are compared among
   themselves: the hub's classes are dealt into blocks, each pair of blocks is one group, and a group compares
   signatures first and then full sets, skipping what it has already joined. Only links come out.

So a large group of near copies costs one comparison per member as far as its members are like its hub, and the
comparisons of the others are spread over many tasks.

Sets are linked from a similarity of ``link / 100``, the caller's. Two classes just there share no bucket with a
probability of 2e-8 for 85 and 3.2e-6 for 80, and their signatures agree in fewer than ``least_slots(link)`` slots with
less than 1e-9, reckoned for independent slots. Nothing else is left to chance but 64-bit hashes of shingles.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.llm.common import map_texts, texts_of
from lapstar.llm.components import components
from lapstar.llm.shingles import digests, shingle_sets
from lapstar.llm.superminhash import bands, signatures
from lapstar.session import save

LINK = 85
SLOTS = 96
PER_BAND = 4
MISSED = 1e-9
BLOCK = 128


def least_slots(link: int) -> int:
    """In so many slots two sets with a similarity of ``link / 100`` agree, but for a probability below ``MISSED``."""
    share, tail = link / 100, 0.0
    for n in range(SLOTS):
        tail += comb(SLOTS, n) * share**n * (1 - share) ** (SLOTS - n)
        if tail >= MISSED:
            return n
    return SLOTS


def described(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, n, d1, d2, bands`` of every row: size and digests of its set, and a key per band."""

    def describe(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        sets, bounds = shingle_sets(data, offsets)
        d1, d2 = digests(sets, bounds)
        keys = bands(signatures(sets, bounds, SLOTS), PER_BAND)
        cuts = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
        return {
            "n": pa.array(np.diff(bounds), pa.int64()), "d1": pa.array(d1), "d2": pa.array(d2),
            "bands": pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.reshape(-1))),
        }

    return map_texts(
        texts_of(docs, text_col=text_col), describe, "doc_id long, n long, d1 long, d2 long, bands array<long>"
    )


def _described_keys(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
    sets, bounds = shingle_sets(data, offsets)
    d1, d2 = digests(sets, bounds)
    return {"n": pa.array(np.diff(bounds), pa.int64()), "d1": pa.array(d1), "d2": pa.array(d2)}


def _alike(n: str, m: str, link: int) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return F.greatest(n, m) * link <= F.least(n, m) * 100


def _linked(common: Column, n: str, m: str, link: int) -> Column:
    return common * 100 >= (F.col(n) + F.col(m) - common) * link


def _members(classes: DataFrame) -> DataFrame:
    """``hub, hub_n, cid, n``: every class of a bucket of several with the hub of that bucket, hubs included."""
    rows = classes.select("cid", "n", F.explode("bands").alias("key"))
    crowded = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    rows = save(rows.join(crowded, "key"), "buckets")
    met = rows.groupBy("cid").agg(F.sum("size").alias("met"))
    first = F.max(F.struct("met", (-F.col("cid")).alias("last"), "n")).alias("first")
    hubs = rows.join(met, "cid").groupBy("key").agg(first)
    hubs = hubs.select("key", (-F.col("first.last")).alias("hub"), F.col("first.n").alias("hub_n"))
    hubs = save(hubs, "hubs")  # so that the join has its own exchanges and a crowded bucket can be split
    return rows.join(hubs, "key").select("hub", "hub_n", "cid", "n").distinct()


def _sets(docs: DataFrame, classes: DataFrame, text_col: str) -> DataFrame:
    """``cid, members``: the full sets of some classes, from the text of one of their documents."""

    def full(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        sets, bounds = shingle_sets(data, offsets)
        d1, d2 = digests(sets, bounds)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
        return {"members": lists, "e1": pa.array(d1), "e2": pa.array(d2)}

    chosen = classes.select("cid", F.col("rep").alias("doc_id"), "d1", "d2")
    texts = texts_of(docs, text_col=text_col).withColumn("at", F.coalesce("doc_id", F.lit(0)))
    chosen = chosen.withColumn("at", F.coalesce("doc_id", F.lit(0))).drop("doc_id")
    schema = "cid long, d1 long, d2 long, members array<long>, e1 long, e2 long"
    found = map_texts(texts.join(chosen, "at"), full, schema, keep=("cid", "d1", "d2"))
    # An id that several texts have is resolved by the digests; equal rows are one.
    return found.filter("d1 = e1 and d2 = e2").select("cid", "members").dropDuplicates(["cid"])


def _compare(rows: pd.DataFrame, link: int) -> pd.DataFrame:
    """Links between different components of one pair of blocks, as few as join them."""
    sets = [np.asarray(x).view(np.uint64) for x in rows["members"]]
    sizes = rows["n"].to_numpy()
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    marks = signatures(np.concatenate(sets), bounds, SLOTS)
    least = least_slots(link)
    cid, block = rows["cid"].to_numpy(), rows["block"].to_numpy()
    hub, one = rows["hub"].iloc[0], rows["i"].iloc[0] == rows["j"].iloc[0]
    parent = {c: c for c in rows["comp"].unique().tolist()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    comp = rows["comp"].tolist()
    found = []
    for x in range(len(rows) - 1):
        if cid[x] == hub:
            continue
        later = np.arange(x + 1, len(rows))
        if not one:
            later = later[block[later] != block[x]]
        small, great = np.minimum(sizes[x], sizes[later]), np.maximum(sizes[x], sizes[later])
        later = later[(great * link <= small * 100) & (cid[later] != hub)]
        if len(later):
            later = later[(marks[later] == marks[x]).sum(1) >= least]
        for y in later.tolist():
            a, b = root(comp[x]), root(comp[y])
            if a != b:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if common * 100 >= (len(sets[x]) + len(sets[y]) - common) * link:
                    parent[max(a, b)] = min(a, b)
                    found.append((int(cid[x]), int(cid[y])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _paired_blocks(members: DataFrame, known: DataFrame) -> DataFrame:
    """``hub, i, j, block, cid, comp, n``: classes of hubs with several components, for each pair of blocks that may hold
    a link between components.

    The largest component of a hub is dealt into blocks of its own, which are never paired among themselves, so one
    class that is apart from a large group costs a row per member of the group, and one itself per block of it.
    """
    rows = members.join(known.withColumnRenamed("node", "cid"), "cid", "left")
    rows = rows.select("hub", "cid", "n", F.coalesce("component", "cid").alias("comp"))
    sizes = rows.groupBy("hub", "comp").agg(F.count("*").alias("own"))
    hubs = sizes.groupBy("hub").agg(
        F.sum("own").alias("size"), F.max(F.struct("own", "comp")).alias("most")
    ).filter("size > most.own and size > 2")
    rows = rows.join(hubs.select("hub", "size", "most.own", F.col("most.comp").alias("largest")), "hub")
    small = F.greatest(F.ceil((F.col("size") - F.col("own")) / BLOCK).cast("int"), F.lit(1))
    rows = rows.withColumn("small", small).withColumn("large", F.ceil(F.col("own") / BLOCK).cast("int"))
    inside, name = F.col("comp") == F.col("largest"), F.xxhash64("cid")
    block = F.when(inside, F.col("small") + F.pmod(name, "large")).otherwise(F.pmod(name, "small")).cast("int")
    others = F.when(inside, F.col("small")).otherwise(F.col("small") + F.col("large"))
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return rows.select("hub", "i", "j", "block", "cid", "comp", "n")


def _across(members: DataFrame, sets: DataFrame, known: DataFrame, link: int) -> DataFrame:
    """Links ``a, b`` between classes of one hub that ``known`` (``node, component``) has in different components."""
    rows = _paired_blocks(members, known).join(sets, "cid")
    return rows.groupBy("hub", "i", "j").applyInPandas(lambda rows: _compare(rows, link), "a long, b long")


def _joined(known: DataFrame, more: DataFrame) -> DataFrame:
    """Components ``node, component`` after the links ``more`` (``a, b``): only components that they join are renamed."""
    if more.isEmpty():
        return known
    for end in ("a", "b"):
        named = known.select(F.col("node").alias(end), F.col("component").alias("to"))
        more = more.join(named, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    new = save(components(more), "components").withColumnRenamed("component", "to")
    renamed = known.join(new.withColumnRenamed("node", "component"), "component", "left")
    renamed = renamed.select("node", F.coalesce("to", "component").alias("component"))
    return renamed.unionByName(new.select("node", F.col("to").alias("component"))).distinct()


def _grouped(docs: DataFrame, text_col: str, link: int) -> DataFrame:
    """``doc_id, n, d1, d2, comp, component_id`` of every row: size and digests of its set, its component (null for an
    empty set), and that component's least id."""
    rows = save(described(docs, text_col), "described")
    key = ["n", "d1", "d2"]
    classes = rows.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = save(_members(classes), "members")
    sets = save(_sets(docs, classes.join(members.select("cid").distinct(), "cid"), text_col), "sets")

    pairs = members.filter("cid <> hub").filter(_alike("n", "hub_n", link))
    pairs = pairs.join(sets.withColumnRenamed("members", "own"), "cid")
    pairs = pairs.join(sets.select(F.col("cid").alias("hub"), "members"), "hub")
    common = F.size(F.array_intersect("own", "members")).cast("long")
    links = pairs.withColumn("common", common).filter(_linked(F.col("common"), "n", "hub_n", link))
    known = save(components(links.select(F.col("hub").alias("a"), F.col("cid").alias("b"))), "components")
    known = _joined(known, save(_across(members, sets, known, link), "more-links"))

    named = classes.join(known.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.select(*key, "rep", F.coalesce("component", "cid").alias("comp"))
    ids = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(ids, "comp").select(*key, "comp", "component_id")
    found = rows.select("doc_id", *key).join(named, key, "left")
    component = F.when(F.col("comp").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", *key, "comp", component.alias("component_id"))


def group(docs: DataFrame, text_col: str = "text", link: int = LINK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``, linked from a similarity of ``link / 100``.

    A null text, an empty one and one without words has an empty set, is linked with nothing and stays. Rows with a
    null id take part; a component without any id has a null one, and its rows stay. Repeated rows are copies of each
    other with one id, so either all of them are ``kept`` or none. Only ``doc_id`` and the text are read.
    """
    found = _grouped(docs, text_col, link).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, text_col: str = "text", link: int = LINK) -> DataFrame:
    """One row of each component, with all its columns: one with the smallest id; rows with a null id stay.

    An id may have several texts: it is a row that goes or stays, told by id and set. Of several texts of one component
    under its smallest id the one with the least size and digests stays; of equal rows, or rows of one id without words, one.
    """
    key = ["n", "d1", "d2"]
    found = _grouped(docs, text_col, link).filter("doc_id is not null")
    found = save(found.groupBy("doc_id", *key, "comp", "component_id").agg(F.count("*").alias("rows")), "texts")
    first = found.filter("comp is not null and doc_id = component_id").groupBy("comp")
    first = save(first.agg(F.min(F.struct(*key)).alias("first")), "first")
    kept = F.col("comp").isNull() | ((F.col("doc_id") == F.col("component_id")) & (F.struct(*key) == F.col("first")))
    found = save(found.join(first, "comp", "left").select("doc_id", *key, "rows", kept.alias("kept")), "kept")
    ids = found.groupBy("doc_id").agg(
        F.bool_or("kept").alias("some"), F.bool_and("kept").alias("every"), F.sum("rows").alias("rows")
    )
    # The smaller part, mostly; stored, so that Spark knows its size and broadcasts it only below its threshold.
    gone = save(ids.filter("not some").select("doc_id"), "gone")
    stay = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    several = save(ids.filter("some and rows > 1").select("doc_id"), "several")
    if several.isEmpty():
        return stay
    # Ids with several rows: the sets of these rows are told again from their texts.
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = stay.join(several, "doc_id", "left_semi").select(*docs.columns).toDF(*names)
    at = names[docs.columns.index("doc_id")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    told = map_texts(rows, _described_keys, f"{schema}, n long, d1 long, d2 long", names[docs.columns.index(text_col)], tuple(names))
    right = found.filter("kept").select(F.col("doc_id").alias(at), *key).join(several.withColumnRenamed("doc_id", at), at, "left_semi")
    once = told.join(right, [at, *key], "left_semi").dropDuplicates([at, *key]).select(*names).toDF(*docs.columns)
    return stay.join(several, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
