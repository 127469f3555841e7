"""Fuzzy line deduplication by MinHash.

A line is the set of its five-character shingles. One hash of every shingle gives a signature: the range of hashes is cut
into registers, each keeps its smallest hash, and an empty one takes that of another, always in the same order. Bands of
registers are bucket keys. Members of a bucket meet unless the parities of their shingles show that they can't be
alike; the exact Jaccard similarity of the whole lines decides, union-find joins the links, and one line of
each component stays.

Shingles are hashed and compared in numpy; all else are DataFrame functions. Texts are shuffled only where something is to be done:
masks of a fixed size, broadcast, tell which buckets, lines and rows may matter. They let a few more pass, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.buckets import linked, parities
from meterlake.llm.shared import marked, mask_of, masked, packed, release, settled, tidy

SIMILARITY = 0.8
SHINGLE = 5
BANDS, BAND_ROWS = 20, 6  # misses a pair of similarity 0.8 with probability 0.0023, one of 0.85 with 0.00001
#: Registers whose last two bits make the sketch that buckets are sorted by.
SKETCHED = 32
#: Words of the marks that rule pairs out; lines of up to 2,000 shingles need so many.
MARK_WORDS = 16
#: Bands whose keys are shuffled at once. More rounds take less disk, and hardly more time.
ROUND_BANDS = 5
#: Lines that a task remembers, so that one which stands there often has keys only once or a few times.
REMEMBERED = 1 << 20
#: Bytes of lines whose shingles a task holds at once. More of them take more memory, and no less time.
SHINGLE_BYTES = 1 << 17
#: Bits of a shingle's hash by which lines are compared; the number of the line in its piece stands above them.
HASH_BITS = np.uint64(52)
_NONE = np.uint64(2**64 - 1)


def line_rows(source: DataFrame) -> DataFrame:
    """Lines that aren't blank: row, number, hash, and a place to order them by: id, then line."""
    lines = source.select("doc_id", "r1", "r2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    lines = lines.where(F.ltrim("line", F.lit(" \t\x0b\f\r")) != "")
    # Rows without an id come last, in the order of a hash of their text.
    after = F.col("r1").cast("decimal(20,0)") + F.lit(str(2**64)).cast("decimal(20,0)")
    document = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), after.cast("decimal(20,0)"))
    place = document * F.lit(2**32).cast("decimal(10,0)") + F.col("at").cast("decimal(10,0)")
    return lines.withColumn("lh", F.xxhash64("line")).withColumn("place", place.cast("decimal(36,0)"))


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one behind another, and where each text's begin."""
    at = np.append(0, np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)))
    data, _ = arrays.column_bytes(column)
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), at


def line_shingles(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and line of every shingle, repeated ones too, and how many each line has. A shorter line is its own shingle."""
    n, length = len(at) - 1, np.diff(at)
    size = np.where(length < SHINGLE, np.minimum(length, 1), length - SHINGLE + 1)
    owner = np.repeat(np.arange(n), size)
    padded = np.concatenate([codes, np.zeros(SHINGLE, codes.dtype)]).astype(np.uint64)
    h = _hashed([padded[j : j + len(codes)] for j in range(SHINGLE)])
    # Everywhere a shingle begins but at the last places of a line; of a short line only the first place counts.
    begins, long = np.ones(len(codes), bool), length >= SHINGLE
    for j in range(1, SHINGLE):
        begins[at[1:][long] - j] = False
        begins[at[:-1][~long & (length > j)] + j] = False
    h = h[begins]
    short = np.flatnonzero(~long & (length > 0))
    if len(short):  # what follows is another line; one more than the code points there are stands for the end
        letters = [np.where(length[short] > j, padded[at[short] + j], np.uint64(0x110000)) for j in range(SHINGLE)]
        h[(np.cumsum(size) - size)[short]] = _hashed(letters)
    return h, owner, size


def _hashed(letters: list[np.ndarray]) -> np.ndarray:
    low = letters[0] | (letters[1] << np.uint64(21)) | (letters[2] << np.uint64(42))
    return arrays.mixed(arrays.mixed(low) ^ (letters[3] | (letters[4] << np.uint64(21))))


def distinct_shingles(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Every shingle of a line once, in order: the number of the line, below 4,096 (`arrays.pieces`), and bits of the hash."""
    keys = (owner.astype(np.uint64) << HASH_BITS) | (h >> (np.uint64(64) - HASH_BITS))
    keys.sort()
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def owners(keys: np.ndarray) -> np.ndarray:
    """The line of each shingle of `distinct_shingles`."""
    return (keys >> HASH_BITS).astype(np.int64)


def similar(text: pa.Array, other: pa.Array, similarity: float) -> np.ndarray:
    """For each pair of lines whether their Jaccard similarity is at least the one given."""
    sides = [distinct_shingles(*line_shingles(*code_points(lines))[:2]) for lines in (text, other)]
    keys = np.concatenate(sides)
    keys.sort()
    twice = keys[1:][keys[1:] == keys[:-1]]
    shared, both = (np.bincount(owners(k), minlength=len(text)) for k in (twice, keys))
    return shared >= similarity * (both - shared) - 1e-9


def line_signatures(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers of each line, and how many shingles it has; codes are the code points of all lines, at where they begin."""
    h, owner, size = line_shingles(codes, at)
    return signatures(h, owner, size), size


def signatures(h: np.ndarray, owner: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Registers of each line from its shingles, repeated ones or not."""
    registers, n = BANDS * BAND_ROWS, len(size)
    register = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
    held = np.full(n * registers, _NONE, np.uint64)
    np.minimum.at(held, owner * registers + register, h)
    filled = held != _NONE
    whole = held.copy()
    empty = np.flatnonzero(~filled & np.repeat(size > 0, registers))
    turn = 0
    while len(empty):  # every empty register asks others in an order of its own, the same in all lines
        turn += 1
        row, own = empty // registers, (empty % registers).astype(np.uint64)
        asked = row * registers + (arrays.mixed(own + np.uint64(turn * registers)) % np.uint64(registers)).astype(np.int64)
        if turn > 256:  # hardly any register is filled: take the smallest hash
            whole[empty] = np.where(filled, held, _NONE).reshape(n, registers).min(axis=1)[row]
            break
        got = filled[asked]
        whole[empty[got]] = held[asked[got]]
        empty = empty[~got]
    return whole.reshape(n, registers)


def line_sketches(lines: DataFrame) -> DataFrame:
    """(lh, sketch, bands) of lines (lh, line). A line that a task meets again may be left out."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in arrays.pieces(batches, SHINGLE_BYTES):
            fresh = []
            for i, lh in enumerate(batch.column("lh").to_pylist()):
                if lh not in seen:
                    seen.add(lh)
                    fresh.append(i)
            if len(seen) > REMEMBERED:
                seen.clear()
            batch = batch.take(pa.array(fresh, pa.int64()))
            h, owner, size = line_shingles(*code_points(batch.column("text")))
            n = len(size)
            drawn = signatures(h, owner, size)
            bands = np.zeros((n, BANDS), np.uint64)
            for j in range(BAND_ROWS):
                bands = arrays.mixed(bands * np.uint64(31) + drawn[:, j::BAND_ROWS])
            bands = arrays.mixed(bands + np.arange(BANDS, dtype=np.uint64))
            bits = (arrays.mixed(drawn[:, :SKETCHED]) & np.uint64(3)) << np.arange(0, 2 * SKETCHED, 2, dtype=np.uint64)
            sketch = np.bitwise_or.reduce(bits, axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(arrays.as_long(bands.ravel())))
            yield pa.RecordBatch.from_arrays([batch.column("lh"), pa.array(arrays.as_long(sketch)), lists], names=["lh", "sketch", "bands"])

    rows = lines.select("lh", F.col("line").alias("text"))
    return rows.mapInArrow(draw, "lh long, sketch long, bands array<long>")


def line_marks(texts: DataFrame) -> DataFrame:
    """(key, size, marks) of lines (lh, line): the number of different shingles, and their parities."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, SHINGLE_BYTES):
            h = distinct_shingles(*line_shingles(*code_points(batch.column("text")))[:2])
            owner = owners(h)
            size = pa.array(np.bincount(owner, minlength=batch.num_rows), pa.int32())
            marks = parities(h, owner, batch.num_rows, MARK_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column("key"), size, marks], names=["key", "size", "marks"])

    rows = texts.select(F.col("lh").alias("key"), F.col("line").alias("text"))
    return rows.mapInArrow(draw, "key long, size int, marks array<long>")


def bucket_members(drawn: DataFrame) -> DataFrame:
    """(bucket, key, sketch) of all buckets that several lines share, some bands at a time."""
    rounds = []
    for first in range(1, BANDS + 1, ROUND_BANDS):
        bands = F.slice("bands", first, ROUND_BANDS)
        keys = drawn.select(F.explode(bands).alias("bucket"), F.col("lh").alias("key"), "sketch")
        # First the buckets of several lines, by aggregation; then only their members are shuffled.
        shared = keys.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
        shared = settled(shared.select("bucket"))
        tidy(drawn.sparkSession)  # that shuffle holds a row for each line and band of the round
        members = masked(keys, "bucket", mask_of(shared, "bucket")).distinct().join(shared, "bucket", "left_semi")
        rounds.append(settled(members))
    return reduce(DataFrame.unionByName, rounds)


def similar_lines(lines: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the hashes of lines that are linked to a different line by similarity."""
    drawn = settled(line_sketches(lines))
    members = bucket_members(drawn)
    company = members.groupBy("bucket").agg(F.count("*").alias("company"))
    members = settled(members.join(company, "bucket"))
    release(drawn)
    # Only lines that share a bucket are shuffled, once; a mask of a fixed size tells which.
    wanted = settled(members.select(F.col("key").alias("lh")).distinct())
    texts = masked(lines.select("lh", "line"), "lh", mask_of(wanted, "lh")).groupBy("lh").agg(F.min("line").alias("line"))
    texts = settled(texts.join(wanted, "lh", "left_semi"))
    marks = settled(line_marks(texts))

    def limit(x: Column, y: Column) -> Column:
        """What may be in only one of the two, and so at least the difference of their sizes."""
        most = (x + y) * ((1 - similarity) / (1 + similarity)) + 1e-6
        return F.when(F.abs(x - y) <= most, most).otherwise(F.lit(-1.0))

    def verify(pairs: DataFrame, few: bool) -> DataFrame:
        return _verified(pairs, texts, similarity)

    def turned(unsettled: DataFrame, number: int) -> DataFrame:
        """By the sketch, beginning with another register for each number."""
        bit = 2 * (7 * number % SKETCHED)
        start = F.shiftrightunsigned("sketch", bit).bitwiseXOR(F.shiftleft("sketch", 64 - bit)) if bit else F.col("sketch")
        return unsettled.withColumn("turned", start)

    return linked(members, marks, MARK_WORDS, limit, verify, turned)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of line hashes whose lines (lh, line) are similar enough, by all their shingles; pairs is settled."""
    wanted = pairs.select(F.col("a").alias("lh")).unionByName(pairs.select(F.col("b").alias("lh")))
    texts = masked(texts, "lh", mask_of(wanted, "lh"))
    side = lambda s, name: texts.select(F.col("lh").alias(s), F.col("line").alias(name))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, SHINGLE_BYTES):
            good = similar(batch.column("text"), batch.column("other"), similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    joined = pairs.join(side("a", "text"), "a").join(side("b", "other"), "b")
    return joined.select("a", "b", "text", "other").mapInArrow(compare, "a long, b long")


def dropped_lines(source: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Lines to drop: doc_id, r1, r2 and the numbers of the lines, for the rows that lose any."""
    lines = line_rows(source)
    roots = settled(similar_lines(lines, similarity))
    known = lines.groupBy("lh").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    known = known.join(roots.withColumnRenamed("node", "lh"), "lh", "left").where("n > 1 or root is not null")
    known = settled(known.select("lh", F.coalesce("root", "lh").alias("root"), "first"))
    kept = known.groupBy("root").agg(F.min("first").alias("kept"))
    decided = settled(known.join(kept, "root").select("lh", "kept"))
    repeated = masked(lines.select("doc_id", "r1", "r2", "at", "lh", "place"), "lh", mask_of(decided, "lh"))
    gone = repeated.join(decided, "lh").where("place <> kept")
    return gone.groupBy("doc_id", "r1", "r2").agg(F.collect_set("at").alias("gone"))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers. It is split once: a lambda would split it anew for every line it takes."""

    def rest(lines: Column) -> Column:
        left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone))
        return F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n")

    return F.transform(F.array(F.split(text, "\n", -1)), rest)[0]


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Every row of docs as `row`, with `text` without repeated lines, and `lines_cut`.

    Lines end at line feeds. Of every component of similar lines the first stays: that of the smallest id and, in
    one text, the uppermost; rows without an id come last. Rows that share an id count as one document, so a line at
    the same number in each of them stays in each. Blank lines stay. A line is known by a 64-bit hash. Null
    texts stay null, texts may become empty, and no row goes.
    """
    source = packed(docs)
    gone = settled(dropped_lines(source, similarity))
    rows = marked(source, "r1", mask_of(gone, "r1"))
    # Only rows that may lose lines are joined, and so shuffled; their text goes along once, in the row.
    touched = rows.where("may").drop("text").alias("s").join(
        gone.alias("g"),
        (F.col("s.r1") == F.col("g.r1")) & (F.col("s.r2") == F.col("g.r2")) & F.col("s.doc_id").eqNullSafe(F.col("g.doc_id")),
        "left",
    )
    text = F.col("s.row")["text"].cast("string")
    text = F.when(F.col("gone").isNull(), text).otherwise(without_lines(text, F.col("gone")))
    touched = touched.select("s.row", text.alias("text"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_cut"))
    rest = rows.where("not may").select("row", "text", F.lit(0).cast("long").alias("lines_cut"))
    return touched.unionByName(rest)
