"""URL filter: sorted arrays of 64-bit digests, probed by binary search and confirmed by the stored strings.

A listed string is found through ``DigestArray``: the xxhash digests of all entries, sorted, beside the entries
themselves. A probe is a vectorised binary search; entries with an equal digest are compared as strings, so a
collision is never taken for a hit. The arrays are memory-mapped.

Two lists decide about a page. Rules (host, path, verdict) are configuration, a Python list; the longest rule whose host is the page's host or a parent domain and whose path is a prefix of the page's path
wins. Any other page is blocked if its host and path are in the table of listed URLs. That table may be as large as
the pages: it is dealt out by the top bits of the digest, and each part becomes one array in one task.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.session import save

SEED = 42
RULE_LIMIT = 200_000
PART_ENTRIES = 100_000
LEAST_PARTS = 16


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), SEED)


class DigestArray:
    """Strings behind their sorted digests."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray, blob: np.ndarray, order: np.ndarray):
        self.keys, self.ends, self.blob, self.order = keys, ends, blob, order

    @classmethod
    def build(cls, entries: Sequence[str], digests: np.ndarray | None = None) -> DigestArray:
        if digests is None:
            digests = np.fromiter((digest(x) for x in entries), np.uint64, len(entries))
        order = np.argsort(digests, kind="stable")
        encoded = [entries[i].encode() for i in order]
        ends = np.cumsum([0, *map(len, encoded)]).astype(np.int64)
        return cls(digests[order], ends, np.frombuffer(b"".join(encoded), np.uint8), order.astype(np.int64))

    def mapped(self, folder: str | None = None) -> DigestArray:
        """The same arrays, memory-mapped: from files in ``folder``, or without one in anonymous memory, outside Python's heap
        and given back as a whole."""
        found = []
        for name in ("keys", "ends", "blob", "order"):
            values = getattr(self, name)
            if not len(values):
                found.append(values)
            elif folder is None:
                own = np.frombuffer(mmap.mmap(-1, values.nbytes), values.dtype)
                own[:] = values
                found.append(own)
            else:
                path = Path(folder, f"{name}.npy")
                np.save(path, values)
                found.append(np.load(path, mmap_mode="r"))
        return DigestArray(*found)

    def find(self, probes: Sequence[str], digests: np.ndarray | None = None) -> np.ndarray:
        """For each probe its position among the entries given to ``build``, or -1."""
        if digests is None:
            digests = np.fromiter((digest(x) for x in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(probes), -1, np.int64)
        near = np.flatnonzero(at < len(self.keys))
        for i in near[self.keys[at[near]] == digests[near]]:
            want, k = probes[i].encode(), int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self.blob[self.ends[k] : self.ends[k + 1]].tobytes() == want:
                    found[i] = self.order[k]
                    break
                k += 1
        return found


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: str) -> Iterator[str]:
    """The host and its parent domains."""
    yield host
    at = host.find(".")
    while at >= 0:
        yield host[at + 1 :]
        at = host.find(".", at + 1)


def _probes(host: str, path: str, lengths: Sequence[int]) -> Iterator[str]:
    """Texts of all rules that would fit, longest paths first, for the host and then for its parents."""
    for parent in suffixes(host):
        if parent:
            for length in lengths:
                if length <= len(path):
                    yield f"{parent} {path[:length]}"


def match_rules(pages: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null without a rule that fits). Needs ``host`` and ``path``.

    Every parent of a page's host with every prefix of its path that is as long as some rule's path is looked up in the array
    of the rules' digests; host and path are kept apart by a blank, which neither has before its end. Of rules with an equal text the
    first counts. A rule with an empty host fits no page. Lists beyond ``RULE_LIMIT`` are dealt into parts by digest.
    """
    known: dict[str, Rule] = {}
    for rule in rules:
        if rule.host:
            known.setdefault(rule.text, rule)
    lengths = sorted({len(rule.path) for rule in known.values()}, reverse=True)
    if len(known) > RULE_LIMIT:
        return _match_many(pages, known, lengths)
    entries = [f"{rule.host} {rule.path}" for rule in known.values()]
    texts, verdicts = list(known), [rule.verdict for rule in known.values()]

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        array = DigestArray.build(entries).mapped()
        for frame in frames:
            probes: list[str] = []
            owners: list[int] = []
            for row, (host, path) in enumerate(zip(frame["host"], frame["path"], strict=True)):
                own = list(_probes(host, path, lengths))
                probes += own
                owners += [row] * len(own)
            best: dict[int, int] = {}
            found = array.find(probes)
            for i in np.flatnonzero(found >= 0).tolist():
                row, at = owners[i], int(found[i])
                if row not in best or len(texts[at]) > len(texts[best[row]]):
                    best[row] = at
            at = [best.get(row) for row in range(len(frame))]
            frame["rule"] = pd.Series([None if x is None else texts[x] for x in at], index=frame.index, dtype=object)
            frame["rule_verdict"] = pd.Series(
                [None if x is None else verdicts[x] for x in at], index=frame.index, dtype=object
            )
            yield frame

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    return pages.mapInPandas(judge, f"{schema}, rule string, rule_verdict string")


def _match_many(pages: DataFrame, known: dict[str, Rule], lengths: list[int]) -> DataFrame:
    """The same for a list that is too long for every task: probes and rules meet in parts, each with its own array."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for host, path in zip(frame["host"], frame["path"], strict=True):
                own = list(_probes(host, path, lengths))
                if own:
                    yield pd.DataFrame({"host": host, "path": path, "key": own})

    rows = [(f"{rule.host} {rule.path}", text, rule.verdict) for text, rule in known.items()]
    table = pages.sparkSession.createDataFrame(rows, "key string, rule string, rule_verdict string")
    asked = save(pages.select("host", "path").distinct().mapInPandas(ask, "host string, path string, key string"), "asked")
    hit = found_in(asked.select("key"), table.select("key"), max(len(known), asked.count()))
    found = asked.join(hit, "key").join(table, "key")
    best = F.max(F.struct(F.length("rule").alias("size"), "rule", "rule_verdict")).alias("best")
    best = found.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.rule_verdict")
    return pages.join(best, ["host", "path"], "left").select(*pages.columns, "rule", "rule_verdict")


def found_in(keys: DataFrame, listed: DataFrame, entries: int) -> DataFrame:
    """Those of the distinct strings ``key`` that are in ``listed`` (``key``), by digest arrays.

    ``entries`` is about the number of rows of the larger side; each part gets up to ``PART_ENTRIES`` of them.
    """
    bits = max(LEAST_PARTS, -(-entries // PART_ENTRIES) - 1).bit_length()

    def dealt(df: DataFrame) -> DataFrame:
        key = F.xxhash64("key")
        return df.select("key", key.alias("digest"), F.shiftrightunsigned(key, 64 - bits).alias("part")).distinct()

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        array = DigestArray.build(list(right["key"]), right["digest"].to_numpy(np.int64).view(np.uint64)).mapped()
        hit = array.find(list(left["key"]), left["digest"].to_numpy(np.int64).view(np.uint64)) >= 0
        return left.loc[hit, ["key"]]

    return dealt(keys).groupBy("part").cogroup(dealt(listed).groupBy("part")).applyInPandas(probe, "key string")


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, no rule, and is allowed. Pages with equal urls
    get equal rows. ``listed`` has a column ``key``: host and path in one string; null keys are ignored. Columns of
    ``pages`` other than ``page_id`` and ``url`` are left out.
    """
    host, path = url_parts(F.col("url"))
    ruled = match_rules(pages.select("page_id", host.alias("host"), path.alias("path")), rules)
    verdict = F.coalesce("rule_verdict", F.lit("allow"))
    if listed is None:
        return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    key = F.when(F.col("rule").isNull() & (F.col("host") != ""), F.concat("host", "path"))
    keyed = ruled.withColumn("key", key)
    keys = keyed.filter("key is not null").select("key").distinct()
    entries = pages.count()
    blocked = found_in(keys, listed.filter("key is not null").select("key"), entries).withColumn("blocked", F.lit(True))
    verdict = F.when(F.col("blocked"), "block").otherwise(verdict)
    return keyed.join(blocked, "key", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def repeated_urls(pages: DataFrame) -> DataFrame:
    """``key`` (host and path) of the urls that more than one page has: captures of one address."""
    host, path = url_parts(F.col("url"))
    keys = pages.select(F.concat(host, path).alias("key"), "page_id").filter("key <> ''")
    return keys.groupBy("key").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).filter("a < b").select("key")
