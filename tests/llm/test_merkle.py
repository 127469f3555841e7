"""Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest
from llm_making import AWKWARD, SF
from pyspark.sql import functions as F

from meterlake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in row))


def tree(level):
    """The root, and of every leaf the siblings to the left and right on each level."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for leaf_, way in enumerate(ways):
            place = at[leaf_]
            first = place // 3 * 3
            way.append((level[first:place], level[place + 1 : first + 3]))
            at[leaf_] = place // 3
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], ways


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row, leaf(row)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    for leaves in by_source.values():
        leaves.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [tree([d for _, d in by_source[s]]) for s in order]
    root, tops = tree([r for r, _ in trees])
    for source, (subroot, ways), top in zip(order, trees, tops):
        for (row, own), way in zip(by_source[source], ways):
            at = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                at = (*row[:4], row[4].replace("\n", ""))
            node = leaf(at)
            for left, right in way + top:
                node = digest(*left, node, *right)
            proof = digest(*(x for left, right in way + top for x in left + right))
            yield row[0], own, subroot, root, proof, node, node == root


def manifest(docs):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.manifest(docs, F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))))


def same(df, rows):
    assert sorted(map(tuple, manifest(df).collect()), key=repr) == sorted(expected(rows), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_table(spark, rows):
    same(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


def test_one_hot_source(spark):
    """A source of many blocks beside sources of one row, with copies of ancestors for the blocks."""
    rows = [(i, "hot", "en", i % 7, f"text\n{i % 50}") for i in range(2500)]
    rows += [(10_000 + i, f"s{i}", None, None, None) for i in range(11)]
    same(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


@pytest.mark.parametrize("broadcast", [True, False])
def test_ties_nulls_and_repeats(spark, monkeypatch, broadcast):
    monkeypatch.setattr(merkle, "SOURCE_ROWS", 2)
    if not broadcast:
        monkeypatch.setattr(merkle, "BROADCAST_ROWS", -1)
    rows = [(i // 2, None if i % 5 == 0 else "sößé"[: i % 5], "x" if i % 3 else None, i, t) for i, t in enumerate(AWKWARD)]
    rows += [(None, None, None, None, None)] * 2 + [(4, "", "", 0, "")] * 9 + [(4, "", "", 0, "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("digest", "tree", "n", "size", "at", "part", "left", "way", "held"):
        df = df.withColumn(extra, F.lit(1))
    same(df.repartition(3), rows)


def test_longest_text_and_smallest_tables(spark):
    for rows in ([(2, "a", "b", 1, "x\n" * 1_500_000)], [(1, None, None, None, None), (1, "a", None, None, "\n")]):
        same(spark.createDataFrame(rows, SCHEMA), rows)
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_unchanged_rows_verify(spark, rows):
    assert {r.verified for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()} == {True}


def test_ten_levels(spark):
    """Jumps of eight levels, where an ancestor is copied for every block of 81 leaves."""
    docs = spark.createDataFrame([(i, "hot", None, None, None) for i in range(3**9)], SCHEMA)
    found = merkle.manifest(docs)
    assert found.where("verified").count() == found.select("proof_sha256").distinct().count() == 3**9
