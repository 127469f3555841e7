"""Alignment of two tokenizers over the same bytes, and how often their tokens share bytes.

The tokens of both end at ascending byte offsets. The shorter list of ends is searched for in the longer one by
galloping: steps that double until they pass the wanted end, then bisection in the last step. Ends that both lists
have cut the text into groups. The ranks found also say which tokens overlap: between the ranks of two
neighbouring ends lie the tokens that share bytes with the token between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.memory import SpanMemory
from meterlake.llm.shared import settled
from meterlake.llm.token_counts import Merger

SPACE = "▁"
#: Pairs that make up at least one in this many links are broadcast with their counts, so never more than this.
HOT_PAIRS = 1 << 18


class PlainMerger(Merger):
    """Byte-level BPE in which strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.lengths = np.zeros(max(self.vocabulary.values()) + 1, np.int64)
        for token, i in self.vocabulary.items():
            self.lengths[i] = len(token)  # one character stands for one byte
        self.specials = {}
        self.forget()


class Pieces(SpanMemory):
    """Sentence pieces of texts, word by word: blanks and what follows them, up to the next blank.

    No piece holds a blank behind another character, so no merge crosses the border of two words.
    """

    specials: dict[bytes, int] = {}

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("pieces of this model span words")
        self.blank = self.model.piece_to_id(SPACE)
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(pieces)
        ]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        super().forget()
        self.faithful = np.zeros(0, bool)

    def encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that begin with a blank, which the library adds by itself."""
        words = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        encoded = self.model.encode([w[1:].decode("utf-8") for w in words], num_threads=1)
        encoded = [ids if len(w) > 1 else [self.blank] for w, ids in zip(words, encoded)]
        same = [b"".join([self.bytes[i] for i in ids]) == w for w, ids in zip(words, encoded)]
        self.faithful = np.concatenate([self.faithful, np.array(same, bool)])
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((i for ids in encoded for i in ids), np.int32, int(counts.sum())), counts

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and text of each word. Every text begins with a blank."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = data == 0x20
        begin[1:] &= data[:-1] != 0x20
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        return self.entries(data, starts, np.append(starts[1:], len(data))), arrays.owners(starts, offsets)


@lru_cache(1)
def tokenizers(byte_bpe: str, piece_model: str) -> tuple[PlainMerger, Pieces]:
    return PlainMerger(byte_bpe), Pieces(piece_model)


def gallop(wanted: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each wanted value the first place in ends[low:high] that is not below it; high if there is none.

    All searches advance in step: from the guess by steps of 1, 2, 4, ... until the place is passed, up or down,
    then by bisection of the last step.
    """
    last = len(ends) - 1
    left, right = guess.copy(), guess.copy()
    up = np.flatnonzero((guess < high) & (ends[np.minimum(guess, last)] < wanted))
    down = np.flatnonzero((guess > low) & (ends[np.maximum(guess - 1, 0)] >= wanted))
    step = 1
    while len(up):  # ends[left - 1] is below the wanted value
        left[up] = right[up] + 1
        right[up] = np.minimum(right[up] + step, high[up])
        up = up[(right[up] < high[up]) & (ends[np.minimum(right[up], last)] < wanted[up])]
        step *= 2
    step = 1
    while len(down):  # ends[right] is not below it
        right[down] = left[down] - 1
        left[down] = np.maximum(left[down] - step, low[down])
        down = down[(left[down] > low[down]) & (ends[np.maximum(left[down] - 1, 0)] >= wanted[down])]
        step *= 2
    open_ = np.flatnonzero(left < right)
    while len(open_):
        middle = (left[open_] + right[open_]) >> 1
        below = ends[middle] < wanted[open_]
        left[open_[below]] = middle[below] + 1
        right[open_[~below]] = middle[~below]
        open_ = open_[left[open_] < right[open_]]
    return left


@dataclass
class Aligned:
    """Texts of a batch: tokens of both tokenizers, common ends, and all overlapping pairs."""

    ids: tuple[np.ndarray, np.ndarray]
    bounds: tuple[np.ndarray, np.ndarray]  # where the tokens of each text begin
    common: tuple[np.ndarray, np.ndarray]  # tokens of both that end at one byte
    links: np.ndarray  # a and b of every pair in one number
    link_text: np.ndarray


def _tokens(held: SpanMemory, entries: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, byte ends and where each text begins among them."""
    ids, count = held.gather(entries, owner, n)
    return ids, np.cumsum(held.lengths[ids]), np.append(0, np.cumsum(count))


def _spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, with a blank before each that isn't empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    nothing, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    spaced = pc.binary_join_element_wise(nothing, column, blank)
    return arrays.column_bytes(pc.if_else(pc.equal(column, nothing), nothing, spaced))


def align(column: pa.Array, a: PlainMerger, b: Pieces) -> Aligned:
    """Tokens, groups and links of a batch of texts. Texts whose pieces don't give back their bytes have no tokens."""
    data, offsets = _spaced(column)
    words, owner = b.spans(data, offsets)
    n_texts = len(offsets) - 1
    if len(wrong := np.unique(owner[~b.faithful[words]])):
        size = np.diff(offsets)
        size[wrong] = 0
        data = data[arrays.ragged(offsets[:-1], size)]
        offsets = np.append(0, np.cumsum(size))
        right = ~np.isin(owner, wrong)
        words, owner = words[right], owner[right]
    sides = _tokens(a, *a.spans(data, offsets), n_texts), _tokens(b, words, owner, n_texts)
    count = [np.diff(bounds) for _, _, bounds in sides]
    shorter = count[0] <= count[1]
    common, links, link_text = ([], []), [], []
    for drive, chosen in ((0, shorter), (1, ~shorter)):
        (ids, ends, bounds), (other_ids, other_ends, other_bounds) = sides[drive], sides[1 - drive]
        texts = np.flatnonzero(chosen & (count[0] > 0))
        n = count[drive][texts]
        at = arrays.ragged(bounds[texts], n)
        text = np.repeat(texts, n)
        low, high = other_bounds[text], other_bounds[text + 1]
        guess = low + (at - bounds[text]) * (high - low) // np.maximum(1, count[drive][text])
        if not len(at):
            continue
        rank = gallop(ends[at], other_ends, low, high, guess)
        met = other_ends[rank] == ends[at]
        common[drive].append(at[met])
        common[1 - drive].append(rank[met])
        # A token's partners: from the first one that ends behind its start to the one that reaches its end.
        first = np.where(at == bounds[text], low, np.append(0, (rank + met)[:-1]))
        size = rank - first + 1
        mine, others = np.repeat(ids[at], size).astype(np.int64), other_ids[arrays.ragged(first, size)].astype(np.int64)
        links.append((mine << 32 | others) if drive == 0 else (others << 32 | mine))
        link_text.append(np.repeat(text, size))
    none = [np.zeros(0, np.int64)]
    met_a, met_b = (np.sort(np.concatenate(c + none)) for c in common)
    return Aligned(
        (sides[0][0], sides[1][0]), (sides[0][2], sides[1][2]), (met_a, met_b), np.concatenate(links + none), np.concatenate(link_text + none)
    )


@lru_cache(1)
def _numerals(n: int) -> np.ndarray:
    """Decimal numbers below n, followed by a comma, a bar, a semicolon or nothing."""
    return np.array([b"%d%s" % (i, mark) for mark in (b",", b"|", b";", b"") for i in range(n)], object)


def group_digests(held: Aligned, vocabulary: int) -> list[str]:
    """sha256 of the groups of each text, in order; empty for texts without tokens."""
    (ids_a, ids_b), (bounds_a, bounds_b), (met_a, met_b) = held.ids, held.bounds, held.common
    stop_a, stop_b = met_a + 1, met_b + 1  # where each group's tokens end
    begin_b = np.append(0, stop_b)[:-1]
    group = np.arange(len(met_a))
    group_a, group_b = (np.repeat(group, np.diff(stop, prepend=0)) for stop in (stop_a, stop_b))
    written = np.zeros(len(ids_a) + len(ids_b), np.int64)
    place_a = np.arange(len(ids_a)) + begin_b[group_a]
    place_b = np.arange(len(ids_b)) + stop_a[group_b]
    written[place_a] = ids_a
    written[place_b] = ids_b
    written[place_a[met_a]] += vocabulary
    written[place_b[met_b]] += 2 * vocabulary
    bounds = bounds_a + bounds_b
    full = np.flatnonzero(np.diff(bounds))
    written[bounds[full + 1] - 1] += vocabulary
    numerals = _numerals(vocabulary)
    out = [""] * (len(bounds) - 1)
    for i in full.tolist():
        out[i] = hashlib.sha256(b"".join(numerals[written[bounds[i] : bounds[i + 1]]].tolist())).hexdigest()
    return out


def text_sums(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums by text."""
    out = np.zeros(n, np.int64)
    if len(text):
        begin = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        np.add.at(out, text[begin], np.add.reduceat(values, begin))
    return out


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long"


def align_documents(docs: DataFrame, byte_bpe: str, piece_model: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every text, and how usual its links are in all texts.

    Returns doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair is the commonest of its piece, ties
    included), count_sum (corpus-wide count of its pair, over all links) and groups_sha256. One row in, one row out.
    Null and empty texts, and texts that the pieces don't give back byte by byte, have no tokens: zeros and an empty
    digest. Repeated rows count as often as they stand there, null ids too. Other columns are not carried.

    Texts are encoded twice: once to count pairs, which are added up by Spark, once to look counts up. Frequent pairs, at
    most hot_pairs, are broadcast. Links of the rest are joined with their counts; no such pair is a hot key.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(byte_bpe, piece_model)
        for batch in arrays.pieces(batches):
            pair, n = np.unique(align(batch.column("text"), a, b).links, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = settled(rows.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    piece = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("piece")
    most = counts.groupBy(piece).agg(F.max("n").alias("most"))
    counts = counts.withColumn("piece", piece).join(most, "piece").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    counts = settled(counts)
    size = counts.agg(F.sum("n").alias("links"), F.count("*").alias("pairs")).first()
    is_hot = F.col("n") >= F.lit(-(-(size["links"] or 0) // hot_pairs))
    frequent = counts.where(is_hot).toArrow().sort_by("pair")
    table = rows.sparkSession.sparkContext.broadcast(
        tuple(frequent.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(byte_bpe, piece_model)
        known, known_n, known_best = table.value
        for batch in arrays.pieces(batches):
            held = align(batch.column("text"), a, b)
            n = batch.num_rows
            pair, which = np.unique(held.links, return_inverse=True)
            which = which.reshape(-1)
            place = np.searchsorted(known, pair)
            place[place == len(known)] = 0
            hit = known[place] == pair if len(known) else np.zeros(len(pair), bool)
            count, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            count[hit], best[hit] = known_n[place[hit]], known_best[place[hit]]
            rare = np.flatnonzero(~hit[which])
            rare_key, rare_n = np.unique(held.link_text[rare] * len(pair) + which[rare], return_counts=True)
            rare_bounds = arrays.bounds(rare_key // max(1, len(pair)), n)
            lists = [pa.array(pair[rare_key % max(1, len(pair))]), pa.array(rare_n.astype(np.int64))]
            columns = [
                batch.column("doc_id"),
                *(pa.array(np.diff(bounds)) for bounds in held.bounds),
                pa.array(np.diff(np.searchsorted(held.common[0], held.bounds[0]))),
                pa.array(text_sums(np.ones(len(which), np.int64), held.link_text, n)),
                pa.array(text_sums(best[which], held.link_text, n)),
                pa.array(text_sums(count[which], held.link_text, n)),
                pa.array(group_digests(held, max(len(a.lengths), len(b.lengths)))),
                *(pa.ListArray.from_arrays(pa.array(rare_bounds, pa.int32()), x) for x in lists),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{DOCUMENT}, n_best long, count_sum long, groups_sha256 string, rare array<long>, rare_n array<long>"
    names = [part.split()[0] for part in schema.split(", ")]
    found = rows.mapInArrow(look_up, schema)
    if frequent.num_rows == size["pairs"]:
        return found.drop("rare", "rare_n")
    found = settled(found).withColumn("uid", F.monotonically_increasing_id())
    links = found.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("link"))
    links = links.select("uid", F.col("link.rare").alias("pair"), F.col("link.rare_n").alias("of_text"))
    more = links.join(counts.where(~is_hot), "pair").groupBy("uid")
    more = more.agg(F.sum(F.col("of_text") * F.col("n")).alias("more_sum"), F.sum(F.col("of_text") * F.col("best").cast("long")).alias("more_best"))
    found = found.join(more, "uid", "left")
    return found.select(
        *names[:5],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
