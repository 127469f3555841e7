"""Language of texts by bit-sliced Bloom filters over character n-grams.

Every language has a Bloom filter of the n-grams that are frequent in its texts. The filters share their hash
functions and lie across each other: slot i holds the i-th bit of all filters, one bit a language. So one look at the
slots of an n-gram gives all languages that contain it. The bits of a text's n-grams are counted by language,
the hits that a filter gives by chance are taken off, and the language with the most is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.shared import release, settled

#: Letters of an n-gram; the ends of a word count as letters.
SIZES = (3, 4)
SLOT_BITS, HASHES = 20, 3
#: A language's filter holds the n-grams that make up at least one in this many of its n-grams, so never more than this.
NGRAM_SHARE = 1 << 16
#: Languages whose filters lie across each other and are looked at in one pass. More languages take further passes.
LANGUAGES_AT_ONCE = 512
#: Characters of one text that are looked at together.
CHUNK = 1 << 20

UNDETERMINED = "und"


@lru_cache(1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 for anything but a letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        if (c := chr(point)).isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def chunks(text: str) -> Iterator[str]:
    """Parts of a long text, cut at blanks. A run of more than CHUNK characters without one is several words."""
    at = 0
    while len(text) - at > CHUNK:
        cut = text.rfind(" ", at, at + CHUNK)
        cut = at + CHUNK if cut <= at else cut
        yield text[at:cut]
        at = cut
    yield text[at:]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all n-grams of words. No n-gram spans two words."""
    joined = "\0" + "\0".join(texts) + "\0"
    seen = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = seen != 0
    keep[1:] |= keep[:-1]  # one end after each word
    keep[0] = True
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    bounds = np.append(0, np.cumsum(keep))[starts]
    seen = seen[keep].astype(np.uint64)
    hashes, owner = [], []
    for size in SIZES:
        n = len(seen) - size + 1
        if n <= 0:
            continue
        inside = seen[1 : n + 1] != 0
        for j in range(2, size - 1):
            inside &= seen[j : n + j] != 0
        at = np.flatnonzero(inside)
        h = np.full(len(at), size, np.uint64)
        for j in range(0, size, 3):  # three code points fill one word
            packed = [seen[at + i] << np.uint64(21 * (i - j)) for i in range(j, min(j + 3, size))]
            h = arrays.mixed(h ^ sum(packed[1:], packed[0]))
        hashes.append(h)
        owner.append(np.searchsorted(bounds, at + 1, side="right") - 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owner)


@dataclass
class Filters:
    """Bit-sliced filters: bit l of a slot belongs to languages[l], in words of 64 bits or fewer."""

    languages: list[str]
    slots: np.ndarray
    most_frequent: int

    @property
    def word_bits(self) -> int:
        return 8 * self.slots.dtype.itemsize

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that may contain it."""
        mask = np.uint64((1 << SLOT_BITS) - 1)
        found = self.slots[(hashes & mask).astype(np.int64)]
        for j in range(1, HASHES):
            found = found & self.slots[((hashes >> np.uint64(SLOT_BITS * j)) & mask).astype(np.int64)]
        return found

    def bits(self, words: np.ndarray, language: int) -> np.ndarray:
        word, bit = divmod(language, self.word_bits)
        return (words[:, word] >> words.dtype.type(bit)) & words.dtype.type(1)

    def chance(self) -> np.ndarray:
        """Of each language, how likely an n-gram it doesn't contain hits all its bits."""
        filled = [float(self.bits(self.slots, i).mean()) for i in range(len(self.languages))]
        return np.array(filled) ** HASHES


def counted(filters: Filters, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of each text, and hits by text and language."""
    hashes, owner = ngrams(texts)
    found = filters.containing(hashes)
    hits = np.zeros((len(texts), len(filters.languages)))
    for i in range(len(filters.languages)):
        hits[:, i] = np.bincount(owner, weights=filters.bits(found, i), minlength=len(texts))
    return np.bincount(owner, minlength=len(texts)), hits


def corrected(filters: Filters, n: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Hits by text and language without those by chance."""
    chance = filters.chance()
    return np.maximum(0, (hits - n[:, None] * chance) / np.maximum(1 - chance, 1e-9))


def decide(filters: Filters, n: np.ndarray, hits: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the share of the best language in all corrected hits."""
    if not filters.languages:
        return [UNDETERMINED] * len(n), np.zeros(len(n))
    real = corrected(filters, n, hits)
    best = np.where(real.max(axis=1) > 0, real.argmax(axis=1), filters.most_frequent)
    total = real.sum(axis=1)
    score = np.where(total > 0, real.max(axis=1) / np.maximum(total, 1e-300), 0.0)
    languages = [filters.languages[b] if m else UNDETERMINED for b, m in zip(best.tolist(), n.tolist())]
    return languages, np.where(n > 0, score, 0.0)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learned_languages(docs: DataFrame) -> dict[str, int]:
    """Every language that a text is labelled with, and its texts. Only names and counts are collected."""
    known = docs.where("lang is not null and text is not null").groupBy(F.col("lang").cast("string").alias("lang"))
    return {r["lang"]: r["n"] for r in known.agg(F.count("*").alias("n")).orderBy("lang").toLocalIterator()}


def learn(docs: DataFrame, texts_of: dict[str, int] | None = None) -> Filters:
    """Filters from (text, lang) of all given rows; rows without a language teach nothing.

    All n-grams of all texts of the given languages, else of every one, are counted. Collected is at most one word for each
    slot and 64 languages, whatever the data.
    """
    known = docs.where("lang is not null and text is not null")
    if texts_of is None:
        texts_of = learned_languages(docs)
    languages = sorted(texts_of)
    width = next((w for w in (8, 16, 32) if len(languages) <= w), 64)
    words = max(1, -(-len(languages) // width))
    slots = np.zeros((1 << SLOT_BITS, words), f"u{width // 8}")
    if not languages:
        return Filters([], slots, 0)
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            parts: list[list[str]] = [[] for _ in languages]
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang in number:
                    parts[number[lang]] += chunks(text)
            for i, texts in enumerate(parts):
                for first in range(0, len(texts), 1024):
                    hashes, n = np.unique(ngrams(texts[first : first + 1024])[0], return_counts=True)
                    columns = [pa.array(np.full(len(n), i, np.int32)), pa.array(arrays.as_long(hashes)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["language", "h", "n"])

    rows = known.select(F.col("text").cast("string"), F.col("lang").cast("string")).where(F.col("lang").isin(languages))
    counts = rows.mapInArrow(count, "language int, h long, n long").groupBy("language", "h").agg(F.sum("n").alias("n"))
    counts = settled(counts)
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "language").where(F.col("n") * NGRAM_SHARE >= F.col("total"))
    slot = [F.shiftrightunsigned("h", SLOT_BITS * j).bitwiseAND((1 << SLOT_BITS) - 1) for j in range(HASHES)]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("language") % width)
    placed = kept.select(F.explode(F.array(*slot)).alias("slot"), F.expr(f"language div {width}").alias("word"), bit.alias("bit"))
    found = placed.groupBy("slot", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = found.column("bits").to_numpy().view(np.uint64).astype(slots.dtype)
    slots[found.column("slot").to_numpy(), found.column("word").to_numpy()] = bits
    most = min(languages, key=lambda lang: (-texts_of[lang], lang))
    return Filters(languages, slots, number[most])


def identify(rows: DataFrame, filters: Broadcast[Filters], last: bool) -> DataFrame:
    """One pass over texts: looks at the languages of these filters. One row in, one row out, without a shuffle.

    rows has doc_id, held_out, text and what former passes found: lang, the language with the most corrected hits, these
    as best, and total, those of all languages. Of equal languages that of the former pass stays. The last pass gives no text.
    """
    kept = ["doc_id", "held_out"] if last else ["doc_id", "held_out", "text"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filters.value
        for batch in arrays.pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if batch.num_rows == 1:  # maybe a very long one
                n, hits = np.zeros(1, np.int64), np.zeros((1, len(held.languages)))
                for part in chunks(texts[0]):
                    more, further = counted(held, [part])
                    n, hits = n + more, hits + further
            else:
                n, hits = counted(held, texts)
            real = corrected(held, n, hits)
            most, which = real.max(axis=1), real.argmax(axis=1)
            best, total = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("best", "total"))
            former = batch.column("lang").to_pylist()
            lang = [held.languages[w] if better else x for w, better, x in zip(which.tolist(), (most > best).tolist(), former)]
            found = [pa.array(n, pa.int64()), pa.array(lang, pa.string()), pa.array(np.maximum(most, best)), pa.array(total + real.sum(axis=1))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], names=[*kept, "n", "lang", "best", "total"])

    text = "" if last else "text string, "
    asked = rows.select("doc_id", "held_out", "text", "lang", "best", "total")
    return asked.mapInArrow(scored, f"doc_id long, held_out boolean, {text}n long, lang string, best double, total double")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Language of every text, learned from four fifths of the rows that have one.

    docs has doc_id, text and lang. Rows whose id's checksum leaves no remainder by 5 are held out; a null id has no
    checksum, its row is not held out and not learned from. Every language is learned, however rare: LANGUAGES_AT_ONCE of them
    in a pass over the texts, so memory is bounded and the passes grow with the languages. A null text, or one without a
    letter, is `und` with score 0; without a single learned language all are. A text whose n-grams no language contains takes
    the language most texts are in, with score 0. Of equal languages the first by name wins. Repeated rows stay and
    teach as often as they stand there. Other columns are not carried and never looked at.
    """
    doc_id, context = F.col("doc_id").cast("long"), docs.sparkSession.sparkContext
    taught = docs.where(doc_id.isNotNull() & ~is_held_out(doc_id)).select("text", "lang")
    texts_of = learned_languages(taught)
    names = sorted(texts_of)
    rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    rows = rows.select("*", F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("lang"), *(F.lit(0.0).alias(c) for c in ("best", "total")))
    former = None
    for first in range(0, len(names), LANGUAGES_AT_ONCE):
        filters = learn(taught, {lang: texts_of[lang] for lang in names[first : first + LANGUAGES_AT_ONCE]})
        last = first + LANGUAGES_AT_ONCE >= len(names)
        rows = identify(rows, context.broadcast(filters), last)
        if not last:
            rows = settled(rows)
            if former is not None:
                release(former)
            former = rows
    lettered = F.col("n") > 0
    most = min(names, key=lambda lang: (-texts_of[lang], lang)) if names else UNDETERMINED
    lang = F.when(lettered, F.coalesce("lang", F.lit(most))).otherwise(UNDETERMINED)
    score = F.when(lettered & (F.col("total") > 0), F.col("best") / F.col("total")).otherwise(0.0)
    return rows.select("doc_id", "held_out", lang.alias("lang_pred"), score.alias("score"))
