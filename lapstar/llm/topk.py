"""Exact top-k by inner product: the threshold algorithm over sorted lists, one per dimension.

Rows are dealt into blocks. Each pair of a block of queries and a block of candidates is one group: there the
candidates are sorted by every dimension, and a query walks its lists from their better ends in step. What it meets is
scored in full. No row that it has not met yet can score more than the sum of the query's components times the last
values read, so the walk stops as soon as that bound cannot beat the kth score. The blocks' best k meet in one ranking
per query, cut to k rows per task before they are shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
FIRST_STEP = 16


def whole(vector: Column, scale: int = 64) -> Column:
    """Components as ``floor(scale * x)``, in doubles; null for a vector that is null or holds null, NaN or infinity."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    doubles = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)), doubles)


class Lists:
    """Candidates with their sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.up = np.argsort(rows, axis=0, kind="stable").T  # per dimension, from the smallest value on
        self.columns = np.ascontiguousarray(rows.T)

    def best(self, query: np.ndarray, own: int, k: int, stats: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the query's k best rows, ties to the smaller id; rows with the id ``own`` take no part."""
        n = len(self.rows)
        used = np.flatnonzero(query)
        if not len(used):
            pool = np.flatnonzero(self.ids != own)
            keep = pool[np.argsort(self.ids[pool], kind="stable")[:k]]
            return self.ids[keep], np.zeros(len(keep), self.rows.dtype)
        up, down = used[query[used] < 0], used[query[used] > 0]
        seen = np.zeros(n, bool)
        seen[self.ids == own] = True
        pool_ids = np.zeros(0, self.ids.dtype)
        pool_scores = np.zeros(0, self.rows.dtype)
        depth, step = 0, FIRST_STEP
        while depth < n:
            upto = min(n, depth + step)
            mark = np.zeros(n, bool)
            mark[self.up[up, depth:upto]] = True
            mark[self.up[down, n - upto : n - depth]] = True
            fresh = np.flatnonzero(mark & ~seen)
            seen[fresh] = True
            pool_ids = np.concatenate([pool_ids, self.ids[fresh]])
            pool_scores = np.concatenate([pool_scores, self.rows[fresh] @ query])
            if len(pool_ids) > k:
                kth = np.partition(pool_scores, len(pool_scores) - k)[len(pool_scores) - k]
                keep = pool_scores >= kth
                pool_ids, pool_scores = pool_ids[keep], pool_scores[keep]
            depth, step = upto, step * 2
            last_up = self.columns[up, self.up[up, depth - 1]]
            last_down = self.columns[down, self.up[down, n - depth]]
            bound = last_up @ query[up] + last_down @ query[down]
            # An unseen row may still tie with the kth and have a smaller id, so the bound has to be less.
            if (len(pool_ids) >= k and bound < pool_scores.min()) or seen.all():
                break
        if stats is not None:
            stats["scored"] = stats.get("scored", 0) + int(seen.sum())
        order = np.lexsort((pool_ids, -pool_scores))[:k]
        return pool_ids[order], pool_scores[order]


def _numbers(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["vector"].tolist(), np.float64).reshape(len(frame), -1)


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.dtype:
    """A type in which all scores are exact: float64 for sums below 2**53, else 64-bit integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**52:
        return np.dtype(np.float64)
    if most < 2.0**62:
        return np.dtype(np.int64)
    raise OverflowError("an inner product of these vectors does not fit into 64 bits")


def search(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best candidates, all if there are fewer.

    Both frames have ``vec_id`` and ``vector`` (whole numbers as doubles); null vectors take no part. A query is not
    compared with rows that have its id, nor with vectors of another length. Equal rows of ``queries`` are one query;
    equal rows of ``candidates`` count each. Ties go to the smaller id.
    """
    rows = candidates.filter("vector is not null and vec_id is not null").select("vec_id", "vector")
    asked = queries.filter("vector is not null and vec_id is not null").select("vec_id", "vector").distinct()
    n_blocks = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    n_query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("size", F.size("vector")).withColumn("q", block(n_query_blocks)).withColumn("c", every(n_blocks))
    right = rows.withColumn("size", F.size("vector")).withColumn("c", block(n_blocks)).withColumn("q", every(n_query_blocks))

    def best(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(some) and len(others):
            asked, known = _numbers(some), _numbers(others)
            kind = _exact(asked, known)
            lists = Lists(others["vec_id"].to_numpy(np.int64), known.astype(kind))
            for own, row, query in zip(some["vec_id"].tolist(), range(len(some)), asked.astype(kind), strict=True):
                ids, scores = lists.best(query, own, k)
                found.append(pd.DataFrame({
                    "query_id": own, "key": some["key"].iloc[row], "vec_id": ids, "score": scores.astype(np.int64),
                }))
        columns = {"query_id": "int64", "key": "int64", "vec_id": "int64", "score": "int64"}
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})

    left = left.withColumn("key", F.xxhash64("vec_id", "vector"))
    pairs = left.groupBy("q", "c", "size").cogroup(right.groupBy("q", "c", "size"))
    found = pairs.applyInPandas(best, "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
