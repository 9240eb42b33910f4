"""Nearest neighbours by inner product with a hash-prefix forest.

A tree's hash string of a vector has ``SYMBOLS`` symbols; a symbol is the axis, with its sign, that
lies closest to the vector after one of the tree's random rotations. Near vectors agree in long
prefixes. Rows are dealt into shards of about ``SHARD_ROWS``. In a shard each tree is the sorted array of
its rows' strings. A query descends every tree to its longest matching prefix; then all trees ascend
together, one symbol at a time, until their ranges hold enough candidates, which are
scored exactly. At prefix length 0 a range is the whole shard, so small tables are searched in full.

Inner products are reduced to angles by one more component ``sqrt(M^2 - |v|^2)``, ``M`` being the largest
norm; it is 0 in a query. Queries meet every shard in blocks of ``QUERY_ROWS``: a task holds one shard
and one block, whatever the size of the table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import settle

TREES = 56
SYMBOLS = 7
SYMBOL_BITS = 8
SHARD_ROWS = 8192
QUERY_ROWS = 4096
LEAST_CANDIDATES = 3000  # per query over all shards, counted once for each tree that offers them
LEAST_SHARE = 0.1  # likewise, as a share of the rows
SEED = 11


class Forest:
    """Sorted hash strings of one shard's vectors."""

    def __init__(self, vectors: np.ndarray, trees: int, seed: int):
        self.size, width = vectors.shape
        rng = np.random.default_rng(seed)
        self.axes = min(width, 1 << (SYMBOL_BITS - 1))
        self.rotations = [
            np.linalg.qr(rng.standard_normal((SYMBOLS, width, width)))[0][:, :, : self.axes].astype(np.float32)
            for _ in range(trees)
        ]
        self.trees = []
        for rotation in self.rotations:
            strings = self.strings(vectors, rotation)
            order = np.argsort(strings, kind="stable")
            self.trees.append((strings[order], order))

    def strings(self, vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        for one in rotation:
            turned = vectors @ one
            axis = np.abs(turned).argmax(axis=1)
            out = (out << SYMBOL_BITS) | (2 * axis + (turned[rows, axis] > 0))
        return out

    def candidates(self, queries: np.ndarray, least: float):
        """Rows of each query's ranges at the greatest prefix length whose ranges hold ``least`` in all."""
        strings = [self.strings(queries, rotation) for rotation in self.rotations]
        open_ = np.arange(len(queries))
        found: list = [None] * len(queries)
        for known in range(SYMBOLS, 0, -1):
            cut = SYMBOL_BITS * (SYMBOLS - known)
            low, high = np.zeros((2, len(self.trees), len(open_)), np.int64)
            for t, (rows, _) in enumerate(self.trees):
                prefix = strings[t][open_] >> cut
                low[t] = np.searchsorted(rows, prefix << cut)
                high[t] = np.searchsorted(rows, (prefix + 1) << cut)
            enough = (high - low).sum(axis=0) >= least
            for i in np.flatnonzero(enough):
                ranges = [order[a:b] for (_, order), a, b in zip(self.trees, low[:, i], high[:, i]) if b > a]
                mask = np.zeros(self.size, bool)
                mask[np.concatenate(ranges)] = True
                found[open_[i]] = np.flatnonzero(mask)
            open_ = open_[~enough]
            if not len(open_):
                break
        everything = np.arange(self.size)
        return [everything if f is None else f for f in found]


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, v``: vectors of the commonest length (the least of several) that are not zero and have finite components only."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    bad = "exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    rows = rows.dropna().where(f"NOT {bad}").where("exists(v, x -> x <> 0)")
    width = rows.agg(F.mode(F.size("v"), deterministic=True)).first()[0]
    return rows.where(F.size("v") == (width or 0))


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    least_candidates: int = LEAST_CANDIDATES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows found for each row where ``is_query`` holds.

    ``score`` is the inner product in double precision; ties go to the smaller id. A row is no
    candidate for a query with its own id. Null ids, null or zero vectors, those with null or
    non-finite components and those of another length than the commonest (of equally common ones the least) take no part. If an id repeats, each
    of its rows is a candidate and one of them a query. Other columns are ignored; an empty table has no result.
    """
    rows = settle(usable(vectors, id_column, vector_column), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, top = rows.agg(F.count("*"), F.max(norm)).first()
    queries = rows.where(is_query(F.col("id"))).dropDuplicates(["id"])
    shards = max(1, -(-total // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    index = rows.select("id", "v", place(shards).alias("shard"), every(blocks).alias("block"))
    asked = queries.select("id", "v", place(blocks).alias("block"), every(shards).alias("shard"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values("id", kind="stable")
            ids, own = left["id"].to_numpy(), right["id"].to_numpy()
            known, wanted = np.stack(left["v"]), np.stack(right["v"])
            rest = np.sqrt(np.maximum(top**2 - (known**2).sum(axis=1), 0))
            forest = Forest(np.c_[known, rest].astype(np.float32), trees, SEED)
            least = max(least_share, least_candidates / total) * len(left)
            asked = np.c_[wanted, np.zeros(len(wanted))].astype(np.float32)
            for q, found in enumerate(forest.candidates(asked, least)):
                found = found[ids[found] != own[q]]
                scores = known[found] @ wanted[q]
                if len(found) > k:
                    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
                    found, scores = found[scores >= edge], scores[scores >= edge]
                best = np.lexsort((ids[found], -scores))[:k]
                out.append((np.full(len(best), own[q]), ids[found[best]], scores[best]))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    kind = rows.schema["id"].dataType.simpleString()
    near = (
        index.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, f"query_id {kind}, vec_id {kind}, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
