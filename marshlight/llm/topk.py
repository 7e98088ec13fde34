"""Exact top-k search by inner product, as no-random-access aggregation over sorted lists.

The candidates are cut into blocks. A block holds one list per dimension, sorted by component; a query reads all lists
in step, from the end where its own component makes the products large. What has been read bounds each candidate's score from
below and, with the next value of every list, from above. Reading stops once no candidate outside the best k can
reach the k-th lower bound; the scores of those that still can are resolved. Best lists of blocks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
QUERY_ROWS = 128


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component, computed in double; null if a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


class SortedLists:
    """One block of vectors with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates whose id is not `own`, ties to the smaller id."""
        n, dims = self.vectors.shape
        use = np.flatnonzero(query)
        q = query[use].astype(np.float64)
        down = q > 0  # large products first: such a list is read from its end
        lowest = np.where(down, self.values[0, use], self.values[-1, use]) * q
        seen = np.zeros((n, len(use)), dtype=np.float32)
        total = np.zeros(n)
        others = self.ids != own
        k = min(k, int(others.sum()))
        if k == 0:
            return self.ids[:0], total[:0].astype(np.int64)
        at, step = 0, max(64, n // 8)
        possible = others
        while at < n:
            to = min(n, at + step)
            up, back = slice(at, to), slice(n - to, n - at)
            for side, part in ((~down, up), (down, back)):
                rows, values = self.order[part][:, use[side]], self.values[part][:, use[side]]
                total += np.bincount(rows.ravel(), (values * q[side]).ravel(), minlength=n)
                seen[rows, np.flatnonzero(side)[None, :]] = 1
            at = to
            if at == n:
                break
            next_value = np.where(down, self.values[n - at - 1, use], self.values[at, use]) * q
            # Bounds of what is unread; float32 products of 0 and 1 with these sums stay within the slack of 2.
            lower = total + lowest.sum() - seen @ lowest.astype(np.float32)
            upper = total + next_value.sum() - seen @ next_value.astype(np.float32)
            slack = 2.0 + 1e-5 * (np.abs(lowest).sum() + np.abs(next_value).sum())
            kth = np.partition(lower[others], -k)[-k]
            possible = others & (upper + slack >= kth - slack)
            if possible.sum() <= 4 * k:
                break
        rows = np.flatnonzero(possible)
        scores = self.vectors[rows].astype(np.int64) @ query.astype(np.int64)
        chosen = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][chosen], scores[chosen]


def _search_block(k: int):
    def search(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            block = block.assign(dims=block["v"].map(len))
            groups = {d: SortedLists(g["vec_id"].to_numpy(np.int64), np.stack(g["v"].to_numpy()).astype(np.int64).reshape(len(g), d))
                      for d, g in block.groupby("dims")}
            for own, v in zip(queries["vec_id"].to_numpy(np.int64), queries["v"]):
                if len(v) in groups:
                    ids, scores = groups[len(v)].best(np.asarray(v, dtype=np.int64), own, k)
                    found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, factor: int = 1024, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the `k` highest integer inner products of every row that `is_query` marks.

    Candidates are all rows but those with the query's own vec_id; a query with fewer gets all of them. Ties go to
    the smaller vec_id. Rows whose vector or vec_id is null, or whose vector holds a null or non-finite component, take no part; vectors of
    another length than the query's are no candidates of it. Repeated rows count once (of different vectors with one vec_id, the
    smallest array). Other columns are ignored; an empty table gives an empty table.
    """
    rows = vectors.select("vec_id", scaled(F.col("embedding"), factor).alias("v"), is_query.alias("is_query"))
    rows = rows.dropna(subset=["vec_id", "v"]).groupBy("vec_id", "is_query").agg(F.min("v").alias("v"))
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1))).first()
    blocks, sets = -(-n // block_rows), -(-asked // query_rows)
    part = lambda of: F.pmod(F.xxhash64("vec_id"), F.lit(max(of, 1))).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(max(of, 1) - 1)))
    queries = rows.where("is_query").select("vec_id", "v", part(sets).alias("set")).withColumn("block", every(blocks))
    lists = rows.select("vec_id", "v", part(blocks).alias("block")).withColumn("set", every(sets))
    local = queries.groupBy("set", "block").cogroup(lists.groupBy("set", "block")).applyInPandas(
        _search_block(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
