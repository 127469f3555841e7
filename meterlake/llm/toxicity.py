"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings that are typical of toxic texts is learned from labelled texts.
Each text is then described by a few dense numbers: how dense lexicon words are, how close
they stand to words of address, and rates of capitals, punctuation and disguised words. Trees learn from
one part of the labelled texts, and an isotonic curve from the rest turns their margin into a
probability. Nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterlake.llm import arrays
from meterlake.llm.licenses import LOWER, WORD
from meterlake.llm.shared import settled

#: Labelled texts that the lexicon and the model learn from, about; chosen by a hash of the id.
TRAINING_ROWS = 16_000
#: Entries of the lexicon, and the share of toxic texts that an entry must occur in.
LEXICON_SIZE = 2_000
LEXICON_SUPPORT = 0.004
#: Lower bound of the ratio of an entry's frequency in toxic texts to that in others.
LEXICON_RATIO = 4.0
STEMS = (4, 5, 6)
NEAR_WORDS = 6
PARTS = 4  # one of so many labelled texts calibrates, the others train
FOLDS = 3  # lexica for training texts leave out one of so many parts

# Words that address the reader.
SECOND_PERSON = (
    "you your yours yourself yourselves u ur du dich dir dein deine deinen ihr euch sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
).split()

FEATURES = [
    "hits_per_word", "strong_per_word", "stem_hits_per_word", "hits", "strong_hits", "stem_hits", "best_weight",
    "near_second_person", "second_person_per_word", "capitals", "capital_words", "exclamations", "marks",
    "disguised_words", "repeated_letters", "digits",
]


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, and start, end and text of every word."""
    lower = LOWER[data]
    return lower, *arrays.runs(WORD[lower], offsets)


def term_hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of whole words and of their beginnings, and the index of the word of each."""
    out = [(arrays.span_hashes(lower, starts, ends), np.arange(len(starts)))]
    for length in STEMS:
        longer = np.flatnonzero(ends - starts > length)
        begin = starts[longer]
        out.append((arrays.span_hashes(lower, begin, begin + length, salt=length), longer))
    return out


def terms_of(texts: DataFrame, among: list[int] | None = None) -> DataFrame:
    """Distinct words and word beginnings of each text; `among`: only those of these hashes."""
    wanted = None if among is None else np.sort(np.array(among, np.int64))

    def list_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            lower, starts, ends, owner = word_table(*arrays.column_bytes(batch.column("text")))
            for stem, (hashes, word) in enumerate(term_hashes(lower, starts, ends)):
                h, o = arrays.as_long(hashes), owner[word]
                if wanted is not None:
                    known = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h)
                    h, o = h[known], o[known]
                order = np.lexsort((h, o))
                h, o = h[order], o[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new]), pa.array(np.full(int(new.sum()), stem > 0))], names=["term", "stem"]
                )

    return texts.select("text").mapInArrow(list_terms, "term long, stem boolean")


def learn_lexicon(training: DataFrame, toxic: int, clean: int) -> list[tuple[int, bool, float]]:
    """At most LEXICON_SIZE terms by how typical they are of toxic texts: hash, whether a stem, weight.

    Terms of toxic texts come first. Their number is bounded, since each occurs in a fixed share of
    these texts; only those are then counted in the other texts.
    """
    support = max(2.0, LEXICON_SUPPORT * toxic)
    counts = terms_of(training.where("toxic = 1")).groupBy("term", "stem").agg(F.count("*").alias("t"))
    frequent = {(r.term, r.stem): r.t for r in counts.where(F.col("t") >= support).collect()}
    if not frequent:
        return []
    elsewhere = terms_of(training.where("toxic = 0"), [t for t, _ in frequent]).groupBy("term", "stem").count()
    other = {(r.term, r.stem): r["count"] for r in elsewhere.collect()}
    ratios = {k: (t + 0.5) / (toxic + 1) / ((other.get(k, 0) + 0.5) / (clean + 1)) for k, t in frequent.items()}
    typical = [k for k, ratio in ratios.items() if ratio >= LEXICON_RATIO]
    typical.sort(key=lambda k: (-frequent[k] * np.log(ratios[k]), k))
    return [(*k, float(np.log(ratios[k]))) for k in typical[:LEXICON_SIZE]]


def rate(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n).astype(np.float64)


class FeatureMaker:
    """Dense features of texts for a given lexicon."""

    def __init__(self, lexicon: list[tuple[int, bool, float]]):
        entries = sorted(lexicon)
        self.terms = np.array([t for t, _, _ in entries], np.int64)
        self.weights = np.array([w for _, _, w in entries])
        self.strong = np.log(30.0)
        raw = "".join(w + " " for w in SECOND_PERSON).encode()
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = arrays.runs(WORD[data], np.array([0, len(data)]))
        self.address = np.sort(arrays.as_long(arrays.span_hashes(data, starts, ends)))

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(hashes))
        held = arrays.as_long(hashes)
        at = np.minimum(np.searchsorted(self.terms, held), len(self.terms) - 1)
        return np.where(self.terms[at] == held, self.weights[at], 0.0)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        lower, starts, ends, owner = word_table(data, offsets)
        size = np.maximum(np.diff(offsets), 1).astype(np.float64)
        words = np.maximum(rate(owner, n), 1)
        (whole, _), *stems = term_hashes(lower, starts, ends)
        weight = self.weight(whole)
        stem_weight = np.zeros(len(starts))
        for hashes, word in stems:
            stem_weight[word] = np.maximum(stem_weight[word], self.weight(hashes))
        best = np.maximum(weight, stem_weight)
        top = np.zeros(n)
        np.maximum.at(top, owner, best)
        held = arrays.as_long(whole)
        at = np.minimum(np.searchsorted(self.address, held), len(self.address) - 1)
        second = self.address[at] == held
        spots, hit = np.flatnonzero(second), np.flatnonzero(best > 0)
        near = np.zeros(len(hit), bool)
        if len(spots) and len(hit):
            for side in (np.searchsorted(spots, hit), np.searchsorted(spots, hit) - 1):
                spot = spots[np.clip(side, 0, len(spots) - 1)]
                near |= (np.abs(spot - hit) <= NEAR_WORDS) & (owner[spot] == owner[hit])
        text = np.repeat(np.arange(n), np.diff(offsets))
        capital = (data >= 0x41) & (data <= 0x5A)
        letter = (lower >= 0x61) & (lower <= 0x7A)
        digit = (data >= 0x30) & (data <= 0x39)
        mark = (data > 0x20) & ~WORD[lower] & (data < 0x80)
        total = lambda mask: rate(text[mask], n)
        sums = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        in_word = lambda mask: sums(mask)[ends] - sums(mask)[starts]
        length = ends - starts
        shouted = (in_word(capital) == length) & (length > 1)
        # A mark or digit right between two letters of one chunk: the usual way to disguise a word.
        inside = np.zeros(len(data), bool)
        if len(data) > 2:
            inside[1:-1] = letter[:-2] & letter[2:] & (mark | digit)[1:-1] & (data[1:-1] != 0x27) & (data[1:-1] != 0x2D)
            triple = np.zeros(len(data), bool)
            triple[2:] = letter[2:] & (lower[2:] == lower[1:-1]) & (lower[1:-1] == lower[:-2])
        else:
            triple = inside
        return np.column_stack([
            rate(owner, n, best) / words, rate(owner[best > self.strong], n) / words, rate(owner, n, stem_weight) / words,
            rate(owner[weight > 0], n), rate(owner[best > self.strong], n), rate(owner[stem_weight > 0], n), top,
            rate(owner[hit[near]], n) / words, rate(owner[second], n) / words,
            total(capital) / np.maximum(total(letter), 1), rate(owner[shouted], n) / words,
            total(data == 0x21) / size, total(mark) / size, total(inside) / words, total(triple) / words, total(digit) / size,
        ])


def with_features(docs: DataFrame, lexicon: list[tuple[int, bool, float]], keep: list[str]) -> DataFrame:
    """The columns to keep, and the features of the text as a vector."""
    wanted = docs.select(*keep, F.col("text").cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = FeatureMaker(lexicon)
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            values = maker.features(*arrays.column_bytes(batch.column("text")))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel())
            )
            columns = [batch.column(c) for c in keep_names]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*keep_names, "feature_list"])

    fields = [f for f in wanted.schema.fields if f.name in keep]
    keep_names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField("feature_list", T.ArrayType(T.DoubleType()))])
    return wanted.mapInArrow(describe, schema).withColumn("features", array_to_vector("feature_list")).drop("feature_list")


def held_out(doc_id: Column) -> Column:
    """Whether labels of this id are never learned from. A null id has no label and isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class ToxicityModel:
    """Lexicon, trees and calibration curve, or a constant where the labels have but one class."""

    def __init__(self, lexicon, trees, curve, constant: float):
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and `score`; names that clash with the model's own have to be renamed before."""
        if self.trees is None:
            return docs.select(*keep).withColumn("score", F.lit(self.constant))
        rows = with_features(docs, self.lexicon, keep)
        return calibrated(self.trees.transform(rows), self.curve).select(*keep, "score")


def calibrated(rows: DataFrame, curve) -> DataFrame:
    """Probability by the curve; the trees' own probability, at a weight of one hundredth, orders its flat parts."""
    rows = rows.withColumn("p", vector_to_array("probability")[1])
    if curve is None:
        return rows.withColumn("score", F.col("p"))
    rows = curve.transform(rows.drop("prediction"))
    return rows.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("curve") * 0.99 + F.col("p") * 0.01)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> ToxicityModel:
    """Learn from labelled rows that are not held out, about `training_rows` of them.

    Labels other than 0 and 1, null ids, and ids labelled both ways are passed over. Without
    both classes the score is the share of toxic labels, or 0 without labels.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .where("toxic = other")
        .drop("other")
    )
    n = usable.count()
    share = min(1.0, training_rows / max(n, 1))
    chosen = lambda c: F.pmod(F.xxhash64(c), F.lit(1_000_000)) < int(share * 1_000_000)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(chosen(F.col("doc_id")) & ~held_out(F.col("doc_id")))
    training = settled(texts.join(usable.where(chosen(F.col("doc_id"))), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"))
    by_class = {r.toxic: r["count"] for r in training.groupBy("toxic").count().collect()}
    toxic, clean = by_class.get(1, 0), by_class.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel([], None, None, float(toxic > 0))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))
    training = training.select("doc_id", "text", "toxic", F.col("toxic").cast("double").alias("label"), part.alias("part"), fold.alias("fold"))
    fit_part, rest = training.where("part > 0"), training.where("part = 0")

    def lexicon_of(rows: DataFrame) -> list[tuple[int, bool, float]]:
        n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
        return learn_lexicon(rows, n.get(1, 0), n.get(0, 0)) if n.get(1) else []

    # A text's own label must not shape its features, else the trees would trust the lexicon too much: the lexicon
    # for each fold of the training texts is learned from the other folds.
    described = [with_features(fit_part.where(F.col("fold") == f), lexicon_of(fit_part.where(F.col("fold") != f)), ["label"]) for f in range(FOLDS)]
    rows = settled(reduce(DataFrame.unionByName, described))
    lexicon = lexicon_of(fit_part)
    if rows.groupBy("label").count().count() < 2:
        return ToxicityModel([], None, None, toxic / (toxic + clean))
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.3, seed=7).fit(rows)
    rows = settled(with_features(rest, lexicon, ["label"]))
    scored = trees.transform(rows).withColumn("p", vector_to_array("probability")[1])
    if scored.groupBy("label").count().count() < 2:
        return ToxicityModel(lexicon, trees, None, 0.0)
    curve = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="curve").fit(scored.select("p", "label"))
    return ToxicityModel(lexicon, trees, curve, 0.0)


def score_toxicity(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5) of every row of docs.

    A null text scores as an empty one. Repeated rows and null ids stay. Other columns are not carried.
    """
    model = fit_toxicity(docs, labels, training_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = model.score(rows, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns.

    Features are made beside the row, so a column of any name passes unchanged.
    """
    model = fit_toxicity(docs, labels)
    packed = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
    return model.score(packed, ["row"]).where(F.col("score") < threshold).select("row.*")
