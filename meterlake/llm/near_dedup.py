"""Near-duplicate documents by ProbMinHash.

A text is its five-word shingles, weighted by one plus the logarithm of their count. Every shingle is a
Poisson process with its weight as rate, whose arrivals fall on random registers; the first arrival
on each register names the shingle of the signature. Two texts agree on a register with the
probability Jaccard similarity of their weights. A shingle whose next arrival is later than the
last register filled can't change anything and ends early.

Bands of registers give candidates. In each bucket all texts are compared with the one that has the most
company, then, while it holds several components, with texts of other components and with sorted neighbours, others in
every turn. The pairs of a turn stay linear in the texts. In the end all pairs of different components that share a bucket
are looked at; parities of their shingles rule out those that can't be alike. Exact similarities decide, and union-find
joins the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.buckets import linked, parities
from meterlake.llm.licenses import LOWER, WORD
from meterlake.llm.shared import mask_of, masked, packed, settled

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5  # misses a pair of similarity 0.8 with probability 0.00007
#: Bands that members of a bucket are sorted by, after the bucket's own.
SORTED_BANDS = 8
#: Words of the marks that rule pairs out.
MARK_WORDS = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def stepped(k: int) -> np.uint64:
    return np.uint64(int(_STEP) * k % (1 << 64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = LOWER[data]
    starts, ends, owner = arrays.runs(WORD[lower], offsets)
    return arrays.span_hashes(lower, starts, ends), owner


def shingles(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, with their text and count. Fewer words are one shingle."""
    hashes, first = arrays.grams(words, owner, SHINGLE_WORDS)
    of = owner[first]
    begin = arrays.bounds(owner, n)
    short = np.flatnonzero((np.diff(begin) > 0) & (np.diff(begin) < SHINGLE_WORDS))
    if len(short):
        whole = sequence_hashes(words, owner, begin, 7)[short]
        hashes, of = np.concatenate([hashes, whole]), np.concatenate([of, short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return hashes[at], of[at], np.diff(np.append(at, len(hashes)))


def sequence_hashes(words: np.ndarray, owner: np.ndarray, begin: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the word sequence of each text."""
    place = (np.arange(len(words)) - begin[:-1][owner] + 1).astype(np.uint64) if len(words) else words
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(arrays.mixed(words ^ arrays.mixed(place * _STEP + np.uint64(salt))), out=total[1:])
    return arrays.mixed(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64))


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures of n texts; 0 in all registers of a text without shingles."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    time, live, turn = np.zeros(len(hashes)), np.arange(len(hashes)), 0
    while len(live):
        turn += 1
        seed = arrays.mixed(hashes[live] + stepped(2 * turn))
        time[live] += -np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[live]
        register = arrays.mixed(hashes[live] + stepped(2 * turn + 1)) % np.uint64(registers)
        slot = owner[live] * registers + register.astype(np.int64)
        better = time[live] < first[slot]
        slot, arrived = slot[better], live[better]
        np.minimum.at(first, slot, time[arrived])
        won = time[arrived] == first[slot]
        winner[slot[won]] = hashes[arrived[won]]
        last = first.reshape(n, registers).max(axis=1)
        live = live[time[live] < last[owner[live]]]
    return winner.reshape(n, registers)


def sketch(rows: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """Key of the word sequence, total weight, marks and band hashes of every row."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            n = batch.num_rows
            data, offsets = arrays.column_bytes(batch.column("text"))
            words, owner = word_hashes(data, offsets)
            begin = arrays.bounds(owner, n)
            bare = np.diff(begin) == 0  # no words: told apart by the text itself
            text = arrays.span_hashes(data, offsets[:-1], offsets[1:])
            k1 = np.where(bare, text, sequence_hashes(words, owner, begin, 1))
            k2 = np.where(bare, np.uint64(0), sequence_hashes(words, owner, begin, 2) | np.uint64(1))
            hashes, of, count = shingles(words, owner, n)
            weight = weights(count)
            drawn = signatures(hashes, of, weight, n, bands * band_rows).reshape(n, bands, band_rows)
            total = pa.array(np.bincount(of, weights=weight, minlength=n).astype(np.float64))
            value = np.zeros((n, bands), np.uint64)
            for j in range(band_rows):
                value = arrays.mixed(value * _STEP + drawn[:, :, j])
            value = arrays.mixed(value + np.arange(bands, dtype=np.uint64))
            size = np.where(bare, 0, bands)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(arrays.as_long(value[~bare].ravel()))
            )
            columns = [batch.column(c) for c in ("doc_id", "r1", "r2")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(arrays.as_long(k1)), pa.array(arrays.as_long(k2)), total, parities(hashes, of, n, MARK_WORDS), lists],
                names=["doc_id", "r1", "r2", "k1", "k2", "size", "marks", "bands"],
            )

    return rows.select("doc_id", "r1", "r2", "text").mapInArrow(
        draw, "doc_id long, r1 long, r2 long, k1 long, k2 long, size double, marks array<long>, bands array<long>"
    )


def probability_jaccard(a: np.ndarray, v: np.ndarray, b: np.ndarray, w: np.ndarray) -> float:
    """Exact similarity of two weighted sets: sum over shared d of 1 / sum over e of max(v[e] / v[d], w[e] / w[d])."""
    shared, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    v_in, w_in = v[i], w[j]
    ratio = w_in / v_in
    order = np.argsort(ratio, kind="stable")
    v_in, w_in, ratio = v_in[order], w_in[order], ratio[order]
    v_up = np.cumsum(v_in) + (v.sum() - v_in.sum())
    w_down = (np.cumsum(w_in[::-1])[::-1] - w_in) + (w.sum() - w_in.sum())
    last = np.searchsorted(ratio, ratio, side="right") - 1  # of equal ratios
    return float((v_in / (v_up[last] + w_down[last] / ratio)).sum())


def most_apart(similarity: float) -> float:
    """Shares of their weights that two sets of this similarity may have only on their own, both added.

    With shares x and y the similarity is at most the smaller of 1 - x and 1 - y, and at most the mean of f(x) and f(y), where
    f(x) = (1 - x) / (1 + x). As f is convex the sum is largest where one share is 1 - similarity.
    """
    if similarity <= 0.5:
        return 2.0
    other = max(2 * similarity - similarity / (2 - similarity), 0.0)
    return 1 - similarity + (1 - other) / (1 + other)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of keys whose texts are similar enough, exactly."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            n = batch.num_rows
            sides = []
            for name in ("text", "other"):
                hashes, of, count = shingles(*word_hashes(*arrays.column_bytes(batch.column(name))), n)
                sides.append((hashes, weights(count), arrays.bounds(of, n)))
            (ha, wa, ia), (hb, wb, ib) = sides
            good = np.zeros(n, bool)
            for r in range(n):
                x, y = slice(ia[r], ia[r + 1]), slice(ib[r], ib[r + 1])
                good[r] = probability_jaccard(ha[x], wa[x], hb[y], wb[y]) >= similarity - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    # Only texts of the pairs are shuffled; a mask of a fixed size tells which.
    hashed = [pairs.select(F.xxhash64(side).alias("kh")) for side in ("a", "b")]
    texts = masked(texts.withColumn("kh", F.xxhash64("key")), "kh", mask_of(hashed[0].unionByName(hashed[1]), "kh"))
    side = lambda key, text: texts.select(F.col("key").alias(key), F.col("text").alias(text))
    joined = pairs.join(side("a", "text"), "a").join(side("b", "other"), "b")
    return joined.select("a", "b", "text", "other").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Classes of near duplicates: (rows, roots).

    rows has doc_id, r1, r2 (see `packed`) and key for every row of docs; roots has node and root for every
    key that is linked to another. Rows with the same words in the same order share a key; texts without any
    word are copies only if equal, and null counts as empty.
    """
    source = packed(docs)
    drawn = settled(sketch(source, bands, band_rows).withColumn("number", F.monotonically_increasing_id()))
    copies = drawn.groupBy("k1", "k2").agg(F.min("number").alias("key"))
    rows = settled(drawn.select("doc_id", "r1", "r2", "k1", "k2").join(copies, ["k1", "k2"]).drop("k1", "k2"))
    nodes = drawn.join(copies.select(F.col("key").alias("number")), "number", "left_semi")
    nodes = settled(nodes.select(F.col("number").alias("key"), "r1", "r2", "size", "marks", "bands"))
    buckets = nodes.select("key", F.explode("bands").alias("bucket"))
    # Only buckets with company go on. Counting and joining share one shuffle of small rows.
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = settled(buckets.join(sizes, "bucket"))
    company = settled(members.groupBy("key").agg(F.sum("size").alias("company")))
    wanted = settled(nodes.join(company, "key").select("key", "r1", "r2", "size", "marks"))
    texts = masked(source.select("r1", "r2", F.coalesce("text", F.lit("")).alias("text")), "r1", mask_of(wanted, "r1"))
    texts = settled(texts.join(wanted.select("key", "r1", "r2"), ["r1", "r2"]).select("key", "text").distinct())
    ranked = settled(members.select("bucket", "key").join(company, "key"))

    def turned(unsettled: DataFrame, turn: int) -> DataFrame:
        """By the bands that follow the bucket's own, beginning with another one for each number."""
        at = F.pmod(F.array_position("bands", F.col("bucket")).cast("int") + (5 * turn - 1), F.size("bands")) + 1
        order = F.slice(F.concat(F.slice("bands", at, F.size("bands")), F.col("bands")), 2, SORTED_BANDS)
        return unsettled.join(nodes.select("key", "bands"), "key").withColumn("turned", order)

    def limit(x: Column, y: Column) -> Column:
        return F.greatest(x, y) * most_apart(similarity) + 1e-6

    marks = wanted.select("key", "size", "marks")
    return rows, linked(ranked, marks, MARK_WORDS, limit, lambda pairs, few: verified(pairs, texts, similarity), turned)


def classify(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, class_size, is_kept.

    class_id is the smallest doc_id of the class (null if none has an id), class_size counts its rows, and
    is_kept marks the row that stays: that of the smallest id, of rows alike in id and text any one.
    An empty table gives no rows. Other columns are not carried.
    """
    rows, roots = near_duplicates(docs, similarity)
    roots = roots.withColumnRenamed("node", "key")
    labelled = settled(rows.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "r1", "r2")).alias("first")
    classes = labelled.groupBy("root").agg(first, F.count("*").alias("class_size"))
    alike = labelled.join(classes, "root")
    is_first = (F.col("r1") == F.col("first.r1")) & (F.col("r2") == F.col("first.r2"))
    return alike.select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", is_first.alias("is_kept"), "r1", "r2"
    )


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class of near duplicates, all columns unchanged."""
    kept = classify(docs, similarity).where("is_kept").select("r1", "r2")
    rows = packed(docs).select("row", "r1", "r2").join(kept, ["r1", "r2"], "left_semi")
    return rows.dropDuplicates(["r1", "r2"]).select("row.*")
