"""Approximate nearest neighbours by multiprobe p-stable hashing.

Inner products become distances on a sphere: candidates are scaled by the largest norm and given one more
component that fills their norm up to 1, queries are scaled to norm 1. A table hashes a point by `k` Gaussian
projections, each cut into cells of width `w` at a random shift. For a query the chance that a neighbour lies in
a cell is known for each projection, so the cells of a table are visited in order of their joint
chance, until the chances add up to what the wanted recall needs. The candidates of all tables are merged and ranked
by their exact inner product. A sample tells, for each query, which score only few times as many rows as are wanted reach; shards
return no others, so what they return doesn't grow with their number. Queries that find too few in this way look again without it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from meterlake.llm import arrays
from meterlake.llm.shared import settled

TABLES = 12
WIDTH = 1.6
RECALL = 0.95
#: Vectors and queries that the neighbour distance is estimated from.
SAMPLE_ROWS, SAMPLE_QUERIES = 4_000, 400
#: Queries of the sample whose visits are tried out.
PROBED_QUERIES = 128
#: Mean size of a bucket that the number of projections aims at.
BUCKET_ROWS = 128
#: Cells of a table that a query may visit. Queries whose chances don't add up in so many cells, or that find
#: too few neighbours, are searched exhaustively.
PROBES = 512
#: Times the wanted rows that are to reach a query's floor, below which shards return nothing at first.
FLOOR_ROWS = 3
#: Rows of the sample that a floor stands on; for fewer it is carried on beyond them, as the normal distribution goes.
TAIL = 16
#: Share of the sampled queries that may be searched exhaustively before fewer projections are taken.
SHORT_QUERIES = 0.05
#: Rows of a table that one shard holds, and above which a bucket is split.
SHARD_ROWS, SPLIT_ROWS = 16_384, 8_192
#: Queries that meet a shard at once. Visits to a shard don't grow with the rows, so few shards need several rounds.
QUERY_ROWS = 32_768
#: Queries whose visits one task works out.
PROBED_ROWS = 256
SEED = 20_240_607


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array of double), without rows that are null, zero, or hold null or non-finite components.

    Of rows with one id the smallest by its components is taken.
    """
    rows = vectors.where("vec_id is not null and embedding is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(fine & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


@dataclass(frozen=True)
class Index:
    """Parameters of all tables; small, so each task makes its projections itself."""

    dims: int
    norm: float
    tables: int
    hashes: int
    width: float
    cosine: float  # of a query and its last wanted neighbour, on the sphere
    chance: float  # that one table is to reach

    def projections(self) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(SEED)
        a = random.standard_normal((self.dims + 1, self.tables * self.hashes))
        return a, random.uniform(0, self.width, self.tables * self.hashes)

    def padded(self, lists: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(lists), self.dims))
        for i, v in enumerate(lists):
            out[i, : len(v)] = v
        return out

    def projected(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Values of all projections, shifted, for each row and table."""
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True)) if query else self.norm
        u = v / norm
        fill = np.zeros(len(u)) if query else np.sqrt(np.maximum(0.0, 1 - (u * u).sum(axis=1)))
        a, shift = self.projections()
        return (np.column_stack([u, fill]) @ a + shift).reshape(len(v), self.tables, self.hashes)

    def codes(self, cells: np.ndarray) -> np.ndarray:
        """One number for each vector of cells; axis 1 is the table."""
        code = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            code = arrays.mixed(code * np.uint64(31) + cells[..., j].astype(np.int64).view(np.uint64))
        return arrays.as_long(code)

    def probes(self, v: np.ndarray) -> list[list[np.ndarray]]:
        """Buckets to visit, best first, for each query and table.

        None at all for a query whose best PROBES cells of all tables don't reach the wanted recall.
        """
        value = self.projected(v, query=True)
        shift = self.projections()[1].reshape(self.tables, self.hashes)
        spread = np.sqrt(max(1e-12, 1 - self.cosine**2))
        centre = (value - shift) * self.cosine + shift
        home = np.floor(centre / self.width)
        near = np.array([-2, -1, 0, 1, 2])
        cell = home[..., None] + near
        low = (cell * self.width - centre[..., None]) / spread
        chance = normal(low + self.width / spread) - normal(low)
        chance = np.maximum(chance, 1e-30)
        # The best products of some projections contain the best of fewer, so each step keeps the best PROBES.
        total, cells = chance[:, :, 0, :], cell[:, :, 0, :, None]
        for j in range(1, self.hashes):
            total = (total[..., None] * chance[:, :, j, None, :]).reshape(*total.shape[:2], -1)
            both = [np.repeat(cells, len(near), axis=2), np.tile(cell[:, :, j, :], (1, 1, cells.shape[2]))[..., None]]
            cells = np.concatenate(both, axis=3)
            if total.shape[2] > PROBES:
                best = np.argpartition(-total, PROBES, axis=2)[:, :, :PROBES]
                total, cells = np.take_along_axis(total, best, 2), np.take_along_axis(cells, best[..., None], 2)
        order = np.argsort(-total, axis=2, kind="stable")
        total, cells = np.take_along_axis(total, order, 2), np.take_along_axis(cells, order[..., None], 2)
        reached = np.cumsum(total, axis=2)
        needed = np.minimum((reached < self.chance).sum(axis=2) + 1, total.shape[2])
        # Tables that reach more than their part make up for others that reach less.
        missed = np.prod(1 - np.take_along_axis(reached, needed[..., None] - 1, 2)[..., 0], axis=1)
        needed[missed > (1 - self.chance) ** self.tables + 1e-9] = 0
        codes = self.codes(cells)
        return [[codes[i, t, : needed[i, t]] for t in range(self.tables)] for i in range(len(v))]

    def short(self, v: np.ndarray) -> float:
        """Share of the queries that `probes` gives nothing to visit."""
        parts = [self.probes(v[a : a + 16]) for a in range(0, len(v), 16)]
        return float(np.mean([not len(tables[0]) for part in parts for tables in part]))


def normal(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, to 1e-4: the order of probes needs no more."""
    return 1 / (1 + np.exp(-np.clip(1.5976 * x + 0.070566 * x**3, -60, 60)))


def _sample(vectors: DataFrame, n: int) -> list[Row]:
    """At most SAMPLE_ROWS of the n vectors."""
    share = min(1.0, 1.5 * SAMPLE_ROWS / n)
    held = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    return held.select("vec_id", "v").limit(SAMPLE_ROWS).collect()


def fit_index(vectors: DataFrame, k: int, tables: int = TABLES, width: float = WIDTH, recall: float = RECALL) -> Index | None:
    """Choose the number of projections from the row count, and the visits from a bounded sample.

    The distance of the kth neighbour among all rows is the quantile k / n of the distances in the sample.
    Projections are taken away while more than SHORT_QUERIES of the sample can't reach the recall in PROBES cells.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(norm).alias("norm")).first()
    if not facts.n:
        return None
    rows = [r.v for r in _sample(vectors, facts.n)]
    hashes = max(1, round(np.log2(max(2.0, facts.n / BUCKET_ROWS)) / 1.3))
    index = Index(facts.dims, facts.norm, tables, hashes, width, 0.5, 1 - (1 - recall) ** (1 / tables))
    if len(rows) < 2:
        return index
    x = index.padded(rows)
    q = x[:SAMPLE_QUERIES]
    cosine = (q @ x.T) / (np.sqrt((q * q).sum(axis=1))[:, None] * facts.norm)
    cosine = np.sort(cosine[~np.eye(len(q), len(x), dtype=bool)])
    at = len(cosine) - 1 - int(len(cosine) * min(1.0, k / facts.n))
    near = float(np.clip(cosine[max(0, at)], 0.05, 0.999))
    index = replace(index, cosine=near)
    while index.hashes > 1 and index.short(q[:PROBED_QUERIES]) > SHORT_QUERIES:
        index = replace(index, hashes=index.hashes - 1)
    return index


def _hashed(vectors: DataFrame, index: Index) -> DataFrame:
    """A row for each vector and table with its bucket."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 2048):
                rows = batch.slice(part, 2048)
                value = index.projected(index.padded(rows.column("v").to_pylist()), query=False)
                codes = index.codes(np.floor(value / index.width))
                at = pa.array(np.repeat(np.arange(rows.num_rows), index.tables))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(index.tables, dtype=np.int32), rows.num_rows)),
                        pa.array(codes.ravel()),
                        rows.column("vec_id").take(at),
                        rows.column("v").take(at),
                    ],
                    names=["tab", "bucket", "vec_id", "v"],
                )

    return vectors.select("vec_id", "v").mapInArrow(place, "tab int, bucket long, vec_id long, v array<double>")


def _probed(queries: DataFrame, index: Index) -> DataFrame:
    """A row for each query, table and bucket to visit."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 64):
                rows = batch.slice(part, 64)
                probes = index.probes(index.padded(rows.column("v").to_pylist()))
                ids = rows.column("vec_id").to_pylist()
                for query, tables in zip(ids, probes):
                    count = np.array([len(t) for t in tables])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(int(count.sum()), query)),
                            pa.array(np.repeat(np.arange(len(tables), dtype=np.int32), count)),
                            pa.array(np.concatenate(tables)),
                        ],
                        names=["query_id", "tab", "bucket"],
                    )

    return queries.select("vec_id", "v").mapInArrow(visit, "query_id long, tab int, bucket long")


def _floored(queries: DataFrame, vectors: DataFrame, index: Index, n: int, k: int) -> DataFrame:
    """queries with `floor`, a score that about FLOOR_ROWS * k of the n vectors should reach; an estimate from the sample."""
    rows, wanted = _sample(vectors, n), FLOOR_ROWS * k
    m, place = len(rows), wanted * len(rows) / n
    at = max(TAIL, int(np.ceil(place)))
    further = 4 * at if place < at else at
    if wanted >= n or further >= m:
        return queries.withColumn("floor", F.lit(float("-inf")))
    high = lambda share: NormalDist().inv_cdf(1 - share)
    beyond = (high(wanted / n) - high(at / m)) / (high(at / m) - high(further / m)) if further > at else 0.0
    ids, x = np.array([r.vec_id for r in rows]), index.padded([r.v for r in rows])

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                rows = batch.slice(part, 256)
                scores = index.padded(rows.column("v").to_pylist()) @ x.T
                scores[rows.column("vec_id").to_numpy()[:, None] == ids] = -np.inf
                scores.sort(axis=1)
                floor = scores[:, -at] + beyond * (scores[:, -at] - scores[:, -further])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(floor)], names=["vec_id", "v", "floor"])

    return queries.select("vec_id", "v").mapInArrow(lower, "vec_id long, v array<double>, floor double")


def best_of_buckets(
    q: np.ndarray, own: np.ndarray, floor: np.ndarray, wanted: list[np.ndarray], x: np.ndarray, ids: np.ndarray, buckets: np.ndarray, k: int
):
    """For each query the k best rows of the buckets it visits, of those that reach its floor: index of the query, vec_id and score."""
    order = np.lexsort((ids, buckets))
    x, ids, buckets = x[order], ids[order], buckets[order]
    begin = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    codes, end = buckets[begin], np.append(begin[1:], len(buckets))
    query = np.repeat(np.arange(len(q)), [len(w) for w in wanted])
    code = np.concatenate(wanted)
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    known = codes[at] == code
    query, at = query[known], at[known]
    by_bucket = np.argsort(at, kind="stable")
    query, at = query[by_bucket], at[by_bucket]
    cut = np.searchsorted(at, np.arange(len(codes) + 1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for b in np.flatnonzero(np.diff(cut)).tolist():
        asking = query[cut[b] : cut[b + 1]]
        held = x[begin[b] : end[b]]
        scores = q[asking] @ held.T
        scores[own[asking][:, None] == ids[begin[b] : end[b]][None, :]] = -np.inf
        least = floor[asking]
        if scores.shape[1] > k:
            least = np.maximum(least, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
        keep = scores >= (least - 1e-9 * np.maximum(1, np.abs(least)))[:, None]
        i, j = np.nonzero(keep & (scores > -np.inf))
        found.append((asking[i], begin[b] + j, scores[i, j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    who, row, score = (np.concatenate(c) for c in zip(*found))
    if not len(who):  # all met only themselves, or nothing that reaches their floor
        return who, row, score
    order = np.lexsort((ids[row], -score, who))
    who, row, score = who[order], row[order], score[order]
    first = np.searchsorted(who, who)
    kth = score[np.minimum(first + k - 1, len(who) - 1)]
    same = who[np.minimum(first + k - 1, len(who) - 1)] == who
    keep = ~same | (score >= kth - 1e-9 * np.maximum(1, np.abs(kth)))
    who, row = who[keep], row[keep]
    # The score is summed row by row, so that equal vectors have equal scores wherever they lie.
    exact = np.concatenate([np.add.reduce(q[who[a : a + 8192]] * x[row[a : a + 8192]], axis=1) for a in range(0, len(who), 8192)])
    order = np.lexsort((ids[row], -exact, who))
    who, row, exact = who[order], row[order], exact[order]
    keep = (np.arange(len(who)) - np.searchsorted(who, who) < k) & (exact >= floor[who])
    return who[keep], ids[row[keep]], exact[keep]


def _ranked(candidates: DataFrame, asked: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
    """The k best candidates of each query that reach its floor, shard by shard; both sides have tab, shard and block.

    asked has one row for a query and shard, with all the buckets that the query visits there.
    """
    asked = asked.join(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "floor"), "query_id")

    def meet(_, asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        own = asking.query_id.to_numpy()
        who, vec, score = best_of_buckets(
            index.padded(asking.q.tolist()),
            own,
            asking.floor.to_numpy(),
            [np.asarray(b, np.int64) for b in asking.buckets],
            index.padded(held.v.tolist()),
            held.vec_id.to_numpy(),
            held.bucket.to_numpy(),
            k,
        )
        return pd.DataFrame({"query_id": own[who], "vec_id": vec, "score": score})

    keys = ["tab", "shard", "block"]
    candidates = candidates.select(*(F.col(c).alias(c) for c in candidates.columns))
    return asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, index: Index | None = None) -> DataFrame:
    """The k nearest found for each query by inner product: query_id, rank, vec_id, score.

    Both frames hold vec_id and v (see `usable_vectors`). A query's own id is no candidate. Ties go to the smaller
    vec_id. Shorter vectors count as filled up with zeros. Every row is in every table; large buckets are split over
    tasks. A query that can't reach the recall in PROBES cells a table, or that finds fewer than k rows, though there are
    more, is compared with all rows in blocks.
    """
    vectors, queries = settled(vectors), settled(queries)
    index = index or fit_index(vectors, k)
    n, asked = vectors.count(), queries.count()
    if index is None or not asked:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards, blocks = -(-n // SHARD_ROWS), -(-asked // QUERY_ROWS)
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    hashed = _hashed(vectors, index)
    sizes = hashed.groupBy("tab", "bucket").agg(F.count("*").alias("size"))
    sizes = settled(sizes.select("tab", "bucket", F.ceil(F.col("size") / SPLIT_ROWS).cast("int").alias("salts")))
    shard = F.pmod(F.xxhash64("bucket", "salt"), F.lit(shards)).cast("int").alias("shard")
    visits = _probed(queries.repartition(-(-asked // PROBED_ROWS), "vec_id"), index).join(sizes, ["tab", "bucket"])
    visits = visits.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
    visits = settled(visits.select("tab", "bucket", "salt", shard, "query_id"))
    renewed = lambda df: df.select(*(F.col(c).alias(c) for c in df.columns))

    def met(visits: DataFrame, queries: DataFrame) -> DataFrame:
        # A shard that too many queries visit meets them in several rounds; only then its rows are sent more than once.
        # From here on a query's visits to a shard are one row, so joins grow with the queries and not with their buckets.
        asked_of = settled(visits.groupBy("tab", "shard", "query_id").agg(F.collect_set("bucket").alias("buckets")))
        rounds = asked_of.groupBy("tab", "shard").agg(F.count("*").alias("asking"))
        rounds = settled(rounds.select("tab", "shard", F.ceil(F.col("asking") / QUERY_ROWS).cast("int").alias("rounds")))
        of_round = F.pmod(F.xxhash64("query_id"), F.col("rounds")).cast("int").alias("block")
        asking = asked_of.join(rounds, ["tab", "shard"]).select("tab", "shard", of_round, "query_id", "buckets")
        # Only rows of buckets that some query visits are sent at all.
        visited = renewed(visits.select("tab", "bucket", "salt", "shard").distinct())
        salted = hashed.join(sizes, ["tab", "bucket"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int"))
        candidates = salted.join(visited, ["tab", "bucket", "salt"]).join(renewed(rounds), ["tab", "shard"])
        candidates = candidates.select("tab", "shard", F.explode(F.expr("sequence(0, rounds - 1)")).alias("block"), "bucket", "vec_id", "v")
        return _ranked(candidates, asking, queries, index, k)

    def everywhere(short: DataFrame, queries: DataFrame) -> DataFrame:
        all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        parts = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
        everything = vectors.select(F.lit(0).alias("tab"), parts, F.lit(0).cast("long").alias("bucket"), "vec_id", "v", all_blocks)
        of_all = short.select(F.col("vec_id").alias("query_id")).select(
            F.lit(0).alias("tab"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block, "query_id", F.array(F.lit(0).cast("long")).alias("buckets")
        )
        return _ranked(everything, of_all, queries, index, k)

    def lacking(found: DataFrame) -> DataFrame:
        """Queries that have fewer rows than there are for them."""
        have = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"))
        # Not all queries are candidates, so the number of rows to find is one less only for those that are.
        own = vectors.select("vec_id", F.lit(1).alias("own"))
        least = F.least(F.lit(k), F.lit(n) - F.coalesce("own", F.lit(0)))
        rows = queries.select("vec_id").join(have, "vec_id", "left").join(own, "vec_id", "left")
        return settled(rows.where(F.coalesce("n", F.lit(0)) < least).select("vec_id"))

    # Whoever finds enough rows that reach its floor has found the best; the others look again without one.
    floored = settled(_floored(queries.repartition(-(-asked // PROBED_ROWS), "vec_id"), vectors, index, n, k))
    free = queries.withColumn("floor", F.lit(float("-inf")))
    found = settled(met(visits, floored).distinct())
    short = lacking(found)
    again = settled(visits.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_semi"))
    if not again.isEmpty():
        found = settled(found.unionByName(met(again, free)).distinct())
        short = lacking(found)
    for of in (floored, free):
        if short.isEmpty():
            break
        found = settled(found.unionByName(everywhere(short, of)).distinct())
        short = lacking(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
