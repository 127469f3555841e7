"""Neighbour search and exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import ann, queries, topk
from meterlake.llm.shared import settled, ship_package

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def vectors(spark):
    ship_package(spark)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)


def made(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_exact_top_k(spark, vectors):
    ids, x = vectors
    x = np.floor(256 * x).astype(np.int64)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in queries.QUERIES["op10_threshold_topk"](spark, SF).collect()}
    asked = np.flatnonzero(ids % 50 == 0)
    assert len(got) == 5 * len(asked)
    for i in asked:
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:5]
        assert [got[ids[i], n + 1] for n in range(5)] == [(ids[j], scores[j]) for j in order]


def test_threshold_stops_early_and_right():
    random = np.random.default_rng(6)
    values = np.round(random.standard_normal((3000, 4)) ** 3 * 40)
    lists = topk.SortedLists(np.arange(3000), values)
    for own in (-1, 5):
        query = np.array([50.0, -3.0, 0.0, 1.0])
        rows, scores = lists.search(query, own, 5, -np.inf)
        exact = values @ query
        expected = [j for j in np.lexsort((np.arange(3000), -exact)) if j != own][:5]
        assert lists.ids[rows].tolist() == expected and scores.tolist() == exact[expected].tolist()


def test_top_k_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1e18, 1e18]), (50, [-1.0, 0.25]), (9, []),
    ]
    vectors = topk.integer_vectors(made(spark, rows))
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 3, shard_rows=2, query_rows=1).collect()
    by_query = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50)}
    assert [v for v, _ in by_query[0]] == [8, 1, 2] and by_query[0][1][1] == 256 * 128
    assert [v for v, _ in by_query[50]] == [3, 1, 2] and by_query[50][1][1] == -256 * 128 + 64 * 128
    empty = vectors.limit(0)
    assert topk.top_k(empty, empty, 3).count() == 0


def test_large_scores_are_exact(spark):
    big = [float(np.float32(2.0**40 + 2.0**20)), float(np.float32(2.0**20))]
    vectors = topk.integer_vectors(made(spark, [(0, [1.0, 1.0]), (1, big), (2, [v + 0.0 for v in reversed(big)])]))
    got = topk.top_k(vectors, vectors.where("vec_id = 0"), 2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 256 * int(256 * sum(big))), (2, 256 * int(256 * sum(big)))]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_neighbours(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in queries.QUERIES["op5_pstable_ann"](spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    asked = np.flatnonzero(ids % 20 == 0)
    hits = 0
    for i in asked:
        scores = x @ x[i]
        order = [ids[j] for j in np.lexsort((ids, -scores)) if j != i][:20]
        mine = sorted(got[ids[i]])
        assert [n for n, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - x[np.searchsorted(ids, v)] @ x[i]) < 1e-12 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(order))
    assert hits >= 0.9 * 20 * len(asked)


def test_neighbours_of_odd_vectors(spark):
    random = np.random.default_rng(7)
    rows = [(i, [float(v) for v in random.standard_normal(8)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(200, None), (220, [0.0] * 8), (240, [None, 1.0]), (260, [float("nan")]), (260, [1.0])]
    vectors = ann.usable_vectors(made(spark, rows))
    got = ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by_query) <= {0, 20, 40, 100, 120, 260} and all(len(v) == 20 for v in by_query.values())
    # All copies score the same, so they come in order of their ids.
    copies = [v for v, _ in by_query[100] if v == 3 or v > 100]
    assert copies == [3, *range(101, 100 + len(copies))] and len(copies) > 10
    few = vectors.where("vec_id < 5")
    assert ann.nearest(few, few.where("vec_id = 0"), 20).count() == 4
    assert ann.nearest(vectors.limit(0), vectors.limit(0), 20).count() == 0


def test_queries_that_find_too_few_are_searched_exhaustively(spark):
    random = np.random.default_rng(8)
    far = [(i, [float(v) for v in np.eye(16)[0] + random.standard_normal(16) / 1e4]) for i in range(1, 400)]
    vectors = ann.usable_vectors(made(spark, [(0, [-1.0] + [0.0] * 15), *far]))
    got = ann.nearest(vectors, vectors.where("vec_id = 0"), 20).collect()
    x = {i: np.array(v, np.float32).astype(np.float64) for i, v in far}
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == sorted(x, key=lambda i: (x[i][0], i))[:20]


def test_queries_beyond_the_probe_budget_keep_their_recall(spark, monkeypatch):
    random = np.random.default_rng(9)
    x = random.standard_normal((3000, 24)).astype(np.float32)
    vectors = ann.usable_vectors(made(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)]))
    x = x.astype(np.float64)
    fitted = ann.fit_index(vectors, 10)
    monkeypatch.setattr(ann, "PROBES", 1)
    assert ann.fit_index(vectors, 10).hashes < fitted.hashes
    monkeypatch.setattr(ann, "PROBES", 4)
    index = ann.replace(fitted, hashes=9)  # too many for four cells
    assert index.short(x[:100]) > 0.5
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 10, index).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in range(0, 3000, 50):
        order = [j for j in np.lexsort((np.arange(3000), -(x @ x[i]))) if j != i][:10]
        assert len(got[i]) == 10
        hits += len(got[i] & set(order))
    assert hits >= 0.9 * 10 * 60


def test_top_k_of_one_frame_and_scores_near_a_limit(spark):
    """Both sides from one frame; scores that doubles can't tell apart; rows of one id with different vectors."""
    rows = [(i, [1 << 40, (1 << 22) + i % 7]) for i in range(60)] + [(3, [1 << 40, 0]), (3, [1 << 41, 0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_k(df, df.where("vec_id in (0, 50)"), 4, shard_rows=9, query_rows=1).collect()
    held = {i: min(v for j, v in rows if j == i) for i, _ in rows}
    limit = 2**63 - 1
    for q in (0, 50):
        score = {i: min(limit, sum(a * b for a, b in zip(held[q], v))) for i, v in held.items() if i != q}
        exact = {i: sum(a * b for a, b in zip(held[q], v)) for i, v in held.items() if i != q}
        best = sorted(exact, key=lambda i: (-exact[i], i))[:4]
        found = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert {s for _, _, s in found} == {score[i] for i in best}


def test_hot_shards_meet_their_queries_in_rounds(spark, vectors, monkeypatch):
    """Small shards, split buckets and few queries a round find what one large shard finds."""
    ids, x = vectors
    rows = [(int(i), v.tolist()) for i, v in zip(ids[:600], x[:600])] + [(10_000 + i, x[0].tolist()) for i in range(200)]
    df = ann.usable_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    index = ann.fit_index(df, 10)
    asked = df.where("vec_id % 7 = 0")
    whole = sorted(map(tuple, ann.nearest(df, asked, 10, index).collect()))
    for name, value in (("SHARD_ROWS", 100), ("SPLIT_ROWS", 40), ("QUERY_ROWS", 16)):
        monkeypatch.setattr(ann, name, value)
    assert sorted(map(tuple, ann.nearest(df, asked, 10, index).collect())) == whole


def test_a_query_is_one_row_for_each_shard(spark, monkeypatch):
    """However many buckets it visits there; else joins would grow with the buckets of all queries."""
    held, ranked = [], ann._ranked

    def watched(candidates, asked, *others):
        held.append(asked.groupBy("tab", "shard", "block", "query_id").count().agg(F.max("count")).first()[0])
        return ranked(candidates, asked, *others)

    monkeypatch.setattr(ann, "_ranked", watched)
    ship_package(spark)
    vectors = ann.usable_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20).count() > 0
    assert held and set(held) == {1}


def test_shards_return_no_more_rows_when_there_are_more_of_them(spark, monkeypatch):
    """And what queries find is the same as without floors."""
    random = np.random.default_rng(10)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(random.standard_normal((6000, 24)))]
    rows += [(6000 + i, rows[0][1]) for i in range(100)]  # queries of id 0 and their like have more ties than are wanted
    vectors = ann.usable_vectors(made(spark, rows))
    index, made_rows, ranked = ann.fit_index(vectors, 10), [], ann._ranked

    def counted(*given):
        found = settled(ranked(*given))
        made_rows.append(found.count())
        return found

    monkeypatch.setattr(ann, "_ranked", counted)

    def search():
        made_rows.clear()
        got = ann.nearest(vectors, vectors.where("vec_id % 60 = 0"), 10, index).collect()
        return sorted(map(tuple, got)), sum(made_rows)

    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    got, many = search()
    monkeypatch.setattr(ann, "FLOOR_ROWS", 1000)
    assert search()[0] == got
    monkeypatch.undo()
    monkeypatch.setattr(ann, "_ranked", counted)
    whole, few = search()
    assert whole == got and many <= 1.5 * few


def test_queries_whose_floor_is_too_high_look_again(spark, monkeypatch):
    random = np.random.default_rng(11)
    vectors = ann.usable_vectors(made(spark, [(i, [float(c) for c in v]) for i, v in enumerate(random.standard_normal((1000, 8)))]))
    asked, index = vectors.where("vec_id % 20 = 0"), ann.fit_index(vectors, 10)
    expected = sorted(map(tuple, ann.nearest(vectors, asked, 10, index).collect()))
    floored = ann._floored
    monkeypatch.setattr(ann, "_floored", lambda *given: floored(*given).withColumn("floor", F.expr("if(vec_id % 40 = 0, 1e9, double('nan'))")))
    assert sorted(map(tuple, ann.nearest(vectors, asked, 10, index).collect())) == expected
