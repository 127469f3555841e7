"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Vectors become small integers. Every shard of candidates keeps one list for each dimension, sorted by that
component. A query walks all lists at once, from the end that its own component favours. Each vector met is
scored in full. The scores at the current depth bound every vector not yet met, and the walk stops
when this bound cannot beat the kth score found. A first shard gives each query a score to beat
in the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from meterlake.llm.shared import settled

SCALE = 256
#: Vectors of a shard, and queries that a task takes at once.
SHARD_ROWS = 2_048
QUERY_ROWS = 512
FIRST_STEP = 16


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of every component as long; rows with nulls or non-finite components go.

    Components count as doubles. Empty vectors go too.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(fine).select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


class SortedLists:
    """One shard: its vectors, and for each dimension the rows in order of that component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.lists = np.argsort(self.values, axis=0, kind="stable").T.copy()

    def search(self, query: np.ndarray, own: int, k: int, beat: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the best k by (score, smaller id), of those that may reach the score `beat`."""
        n, used = len(self.ids), np.flatnonzero(query)
        met = np.zeros(n, bool)
        met[self.ids == own] = True
        rows, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        if not len(used):  # all scores are 0
            return self.best(np.flatnonzero(~met), np.zeros(n - int(met.sum()), query.dtype), k)
        up = query[used] > 0
        depth, step = 0, FIRST_STEP
        while depth < n:
            last = min(n, depth + step)
            front = np.where(up, n - last, depth)
            reached = self.lists[used[:, None], front[:, None] + np.arange(last - depth)]
            fresh = np.zeros(n, bool)
            fresh[reached.ravel()] = True
            new = np.flatnonzero(fresh & ~met)
            met |= fresh
            if len(new):
                rows, scores = self.best(
                    np.concatenate([rows, new]), np.concatenate([scores, self.values[new] @ query]), k
                )
            depth, step = last, step * 2
            edge = self.lists[used, np.where(up, n - depth, depth - 1)]
            bound = (self.values[edge, used] * query[used]).sum()
            # A vector not yet met scores the bound at most. At an equal score its id could still be smaller.
            kth = max(beat, scores[-1]) if len(scores) == k else beat
            if bound < kth or met.all():
                break
        return rows, scores

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((rows, -scores))[:k]  # rows are in order of ids
        return rows[order], scores[order]


def number_type(*values: np.ndarray) -> type:
    """Doubles where every product sum of such values is an exact integer, else arbitrary precision."""
    dims = max(values[0].shape[1], 1)
    largest = [int(np.abs(v.astype(object)).max()) if v.size else 0 for v in values]
    return np.float64 if largest[0] * largest[-1] * dims < 2**53 else object


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """The k best rows for each query by integer inner product: query_id, rank, vec_id, score.

    Both frames hold vec_id and v (arrays of long). A query's own id is no candidate. Ties go to the smaller
    vec_id. Rows alike in id are one, the smallest by its components, and so are queries. Vectors of another length than the query don't
    compete. Scores beyond a long are set to its limits. Queries and candidates meet in blocks: every block of queries
    is sent once to every shard, and only the best k of each shard come back.
    """
    # Of vectors with one id the smallest by content is taken, so that reruns agree. New columns, so that both frames may
    # come from one.
    vectors, queries = (rows.groupBy(F.col("vec_id").alias("vec_id")).agg(F.min("v").alias("v")) for rows in (vectors, queries))
    shards, blocks = max(1, -(-vectors.count() // shard_rows)), max(1, -(-queries.count() // query_rows))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    candidates = vectors.select(part(shards).alias("shard"), F.size("v").alias("dims"), "vec_id", "v")
    asked = settled(queries.select(part(blocks).alias("block"), F.size("v").alias("dims"), "vec_id", "v"))

    def search(rows: DataFrame, beats: DataFrame | None, shard: F.Column) -> DataFrame:
        sent = asked if beats is None else asked.join(beats, "vec_id", "left")
        sent = sent.withColumn("beat", F.lit(None).cast("string") if beats is None else F.col("beat"))
        sent = sent.select("block", "dims", "vec_id", "v", "beat", F.explode(shard).alias("shard"))

        def meet(_, queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[np.ndarray, ...]] = []
            if len(queries) and len(held):
                q, x = np.stack(queries.v.to_numpy()), np.stack(held.v.to_numpy())
                kind = number_type(q, x)
                lists = SortedLists(held.vec_id.to_numpy(), x.astype(kind))
                for own, beat, row in zip(queries.vec_id.to_numpy(), queries.beat.to_numpy(), q.astype(kind)):
                    found, score = lists.search(row, own, k, -np.inf if beat is None else int(beat))
                    limit = 2**63 - 1
                    score = np.array([min(max(int(s), -limit - 1), limit) for s in score], np.int64)
                    out.append((np.full(len(found), own), lists.ids[found], score))
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*out) if out else [[]] * 3)]
            return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

        keys = ["shard", "dims"]
        pairs = sent.groupBy(*keys, "block").cogroup(_for_blocks(rows, blocks).groupBy(*keys, "block"))
        return pairs.applyInPandas(meet, "query_id long, vec_id long, score long")

    first = settled(search(candidates.where("shard = 0"), None, F.array(F.lit(0))))
    # The kth score of the first shard; fewer found there give nothing to beat.
    beats = first.groupBy("query_id").agg(F.min("score").cast("string").alias("beat"), F.count("*").alias("n"))
    beats = beats.where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "beat")
    rest = search(candidates.where("shard > 0"), beats, F.sequence(F.lit(1), F.lit(shards - 1))) if shards > 1 else None
    found = first if rest is None else first.unionByName(rest)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _for_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Candidates, once for each block of queries that they meet."""
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
