"""Links between the members of buckets: turns that cost little, then all pairs that are left.

All pairs of a bucket would be quadratic, and most of them needless: what similar members link is one component. So a turn
compares every member with one other and with its neighbours, only in buckets that still hold several components. Once the
pairs between different components are few, or turns no longer make them much fewer, every one of them is looked at,
by blocks of members. Marks of a fixed size rule pairs out that can't be alike, without error, and the exact check decides.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlake.llm.arrays import as_long
from meterlake.llm.merkle import ordered, shifts, small
from meterlake.llm.shared import TASK_ROWS, components, settled, settled_in


def ordered_pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


#: Orders that a turn sorts buckets in.
ORDERS = 2
#: Pairs between components, for each member, that are few enough to look at all of them.
PAIRS_A_MEMBER = 256
#: Another turn must leave no more than this share of them.
LEFT = 0.9
#: Members of a block. Two blocks meet in one task.
BLOCK = 1024


def parities(hashes: np.ndarray, owner: np.ndarray, n: int, words: int) -> pa.ListArray:
    """For each of n sets its marks: bit i tells whether the number of its hashes with remainder i is odd.

    hashes must be different within a set. Marks of two sets differ in no more bits than hashes are in only one of them.
    """
    bits = 64 * words
    odd = np.bincount(owner * bits + (hashes % np.uint64(bits)).astype(np.int64), minlength=n * bits) & 1
    marks = np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1).view(np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * words, pa.int32()), pa.array(as_long(marks.ravel())))


def _differing(words: int) -> Column:
    """Bits that the marks of the two sides differ in."""
    return sum((F.bit_count(F.col("marks_a")[i].bitwiseXOR(F.col("marks_b")[i])) for i in range(words)), F.lit(0))


def linked(
    members: DataFrame,
    marks: DataFrame,
    words: int,
    limit: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame, bool], DataFrame],
    turned: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """(node, root) of all members linked to another, from settled members (bucket, key, company).

    marks, settled, has (key, size, marks) of each key: the size of its set, and its `parities` in so many words. limit gives,
    for two sizes, how many hashes may be in only one of two sets that are alike. verify keeps
    those of the pairs (a, b) that are alike; it is told whether the pairs are known to be few. In each bucket
    all meet the member with the most company first. Then, while a bucket holds several components, its
    members go on meeting others and their neighbours, and in the end all of another component. turned adds `turned` to
    members, what their bucket is sorted by: like members should come close, and every number should give another order.
    """
    few = members.count() <= TASK_ROWS
    members = members.coalesce(1) if few else members
    held = marks.coalesce(1) if few else marks
    side = lambda s: held.select(F.col("key").alias(s), F.col("size").alias(f"size_{s}"), F.col("marks").alias(f"marks_{s}"))
    may_be_alike = _differing(words) <= limit(F.col("size_a"), F.col("size_b"))
    best = members.groupBy("bucket").agg(F.max(F.struct("company", "key")).alias("best"))
    stars = members.join(best, "bucket").where("key <> best.key").select(*ordered_pairs("key", "best.key"))
    met = links = None
    turn, former = 0, float("inf")
    while True:
        pairs = stars
        if met is not None:
            pairs = _other_stars(rooted, turn)
            for number in range(ORDERS):
                pairs = pairs.unionByName(_neighbours(turned(rooted, turn * ORDERS + number), few))
        pairs = pairs.distinct()
        pairs = settled_in(pairs if met is None else pairs.join(met, ["a", "b"], "left_anti"), few)
        near = pairs.join(side("a"), "a").join(side("b"), "b").where(may_be_alike)
        more = settled_in(verify(settled_in(near.select("a", "b"), few), few), few)
        if links is not None and more.isEmpty():
            break
        met, links = (pairs, more) if met is None else (met.unionByName(pairs), links.unionByName(more))
        if few:
            met, links = met.coalesce(1), links.coalesce(1)
        roots = settled_in(components(links, few), few)
        rooted = members.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "key"))
        parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        largest = F.max(F.struct("n", "root")).alias("largest")
        between = ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("between")
        # Of two members one was the star, and they have met.
        mixed = parts.groupBy("bucket").agg(F.sum("n").alias("n"), largest, between).where("largest.n < n and n > 2")
        mixed = settled_in(mixed, few)
        left, there = mixed.agg(F.sum("between"), F.sum("n")).first()
        if left is None:
            return roots
        rooted = settled_in(rooted.join(mixed.select("bucket"), "bucket"), few)
        if left <= PAIRS_A_MEMBER * there or left > LEFT * former:
            break
        turn, former = turn + 1, left
    buckets = rooted.groupBy("key").agg(F.collect_set("bucket").alias("buckets"))
    left_over = rooted.select("bucket", "key", "root").join(buckets, "key").join(marks, "key")
    more = settled(verify(settled(_all_between(left_over, mixed, may_be_alike)), False))
    return roots if more.isEmpty() else settled_in(components(links.unionByName(more), few), few)


def _all_between(members: DataFrame, mixed: DataFrame, may_be_alike: Column) -> DataFrame:
    """All pairs of different components that share a bucket and may be alike, each from the first of the buckets they share.

    members has bucket, key, root, all of the key's `buckets` here, size and marks.
    Every pair has a member outside the bucket's largest component. Those members are in blocks, the others too, and
    each block of the first meets every block. So a task holds two blocks, whatever a bucket's size.
    """
    count = mixed.select("bucket", "largest.root", (F.col("n") - F.col("largest.n")).alias("n"), F.col("largest.n").alias("most"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    count = count.select("bucket", F.col("root").alias("main"), blocks("n").alias("blocks"), blocks("most").alias("main_blocks"))
    rows = members.join(count, "bucket").withColumn("is_main", F.col("root") == F.col("main"))
    block = F.pmod(F.xxhash64("key"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("blocks"))).cast("int")
    rows = rows.withColumn("block", block)

    def placed(s: str, chosen: DataFrame, name: str, cells: list[Column]) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{s}") for c in ("root", "size", "marks", "buckets")]
        return chosen.select("bucket", F.col("key").alias(s), *columns, "block", "is_main", *cells).withColumnRenamed("block", name)

    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    others = rows.where("not is_main")
    cells = ["bucket", "block_a", "block_b"]
    first = placed("a", others, "block_a", [F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block_b")]).drop("is_main")
    second = placed("b", others, "block_b", [F.explode(F.sequence(F.lit(0), F.col("block"))).alias("block_a")]).drop("is_main")
    once = (F.col("block_a") < F.col("block_b")) | (F.col("a") < F.col("b"))
    apart = F.col("root_a") != F.col("root_b")
    here = F.col("bucket") == F.array_min(F.array_intersect("buckets_a", "buckets_b"))
    among = first.join(second, cells).where(apart & once & may_be_alike & here)
    first = placed("a", others, "block_a", [F.explode(upto("main_blocks")).alias("block_b")]).drop("is_main")
    second = placed("b", rows.where("is_main"), "block_b", [F.explode(upto("blocks")).alias("block_a")]).drop("is_main")
    to_main = first.join(second, cells).where(apart & may_be_alike & here)
    return among.select(*ordered_pairs("a", "b")).unionByName(to_main.select(*ordered_pairs("a", "b")))


def _other_stars(members: DataFrame, turn: int) -> DataFrame:
    """In each bucket, one member of some component against the members outside its own, another one in each turn."""
    order = F.xxhash64(F.lit(turn), "root"), F.xxhash64(F.lit(turn), "key")
    star = F.min(F.struct(order[0].alias("of_root"), order[1].alias("of_key"), "root", "key")).alias("star")
    stars = members.groupBy("bucket").agg(star)
    pairs = members.join(stars, "bucket").where("root <> star.root")
    return pairs.select(*ordered_pairs("key", "star.key"))


def _neighbours(members: DataFrame, few: bool) -> DataFrame:
    """In each bucket, neighbours of different components in the order of `turned`.

    Members are in order over all partitions, so a bucket may be larger than any task.
    """
    rows = members.select("key", "root", "bucket", "turned")
    if few:  # in one partition, sorted once
        before = F.lag(F.struct("key", "root", "bucket")).over(Window.orderBy("bucket", "turned", "key"))
        near = rows.select("key", "root", "bucket", before.alias("other"))
        pairs = near.where("other.bucket = bucket and other.root <> root")
        return pairs.select(*ordered_pairs("key", "other.key"))
    rows = ordered(rows, "bucket", "turned", "key").withColumn("all", F.lit(0))
    shift = small(shifts(rows, "all")).drop("size", "all")
    rows = settled(rows.join(shift, "part").select("key", "root", "bucket", (F.col("at") + F.col("shift")).alias("n")))
    before = rows.select(F.col("key").alias("other"), F.col("root").alias("other_root"), F.col("bucket").alias("in"), (F.col("n") + 1).alias("n"))
    pairs = rows.join(before, "n").where("bucket = in and root <> other_root")
    return pairs.select(*ordered_pairs("key", "other"))
