"""Bit-sliced Bloom filters and the languages they predict."""

import zlib
from collections import Counter

import numpy as np
import pytest
from llm_making import AWKWARD, SF
from pyspark.sql import functions as F

from meterlake.llm import arrays, langid
from meterlake.llm.shared import ship_package

SCHEMA = "doc_id long, text string, lang string"
#: As many languages as need two words of bits.
MANY = [f"l{i:02}" for i in range(70)]


def plain_ngrams(text):
    out, word = [], ""
    for c in text + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            padded = f"\0{word}\0"
            out += [padded[i : i + n] for n in (3, 4) for i in range(len(padded) - n + 1)]
            word = ""
    return out


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_ngrams_equal_plain_ones():
    texts = ["", "a", "Ab cd", "x1y", "Straße ǅ İ", "日本語 ab", " \n", "'s it's"] + [t or "" for t in AWKWARD[:18]]
    hashes, owner = langid.ngrams(texts)
    plain = [(n, i, gram) for n in langid.SIZES for i, text in enumerate(texts) for gram in plain_ngrams(text) if len(gram) == n]
    assert owner.tolist() == [i for _, i, _ in plain]
    pairs = {(gram, h) for (_, _, gram), h in zip(plain, hashes.tolist())}
    assert len(pairs) == len({gram for gram, _ in pairs}) == len({h for _, h in pairs})


def corpus(spark, languages, per_language=40):
    rng = np.random.default_rng(5)
    rows = []
    for lang in languages:
        syllables = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 3)) for _ in range(12)]
        for _ in range(per_language):
            rows.append((len(rows), " ".join("".join(rng.choice(syllables, 2)) for _ in range(25)), lang))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_filters_hold_exactly_the_frequent_ngrams(spark):
    """No n-gram of a language is missing, and others hit as rarely as the filters' fill says."""
    ship_package(spark)
    df, rows = corpus(spark, MANY)
    filters = langid.learn(df)
    assert filters.languages == MANY and filters.slots.shape == (1 << langid.SLOT_BITS, 2)
    own = {lang: np.unique(langid.ngrams([t for _, t, x in rows if x == lang])[0]) for lang in MANY}
    by_chance = []
    for i, lang in enumerate(MANY):
        assert filters.bits(filters.containing(own[lang]), i).all()
        other = np.setdiff1d(own[MANY[i - 1]], own[lang])
        by_chance.append(filters.bits(filters.containing(other), i).mean())
    assert abs(np.mean(by_chance) - filters.chance().mean()) < 1e-3


def test_rare_ngrams_are_left_out(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(langid, "NGRAM_SHARE", 90)
    df, rows = corpus(spark, ["a"])
    counts = Counter(langid.ngrams([t for _, t, _ in rows])[0].tolist())
    filters = langid.learn(df)
    held = np.array([h for h, n in counts.items() if n * 90 >= counts.total()], np.uint64)
    rest = np.array([h for h, n in counts.items() if n * 90 < counts.total()], np.uint64)
    assert 0 < len(held) <= 90 and filters.containing(held).all() and not filters.containing(rest).any()


def test_corrected_counts_decide():
    """A language whose filter is full wins nothing by it."""
    slots = np.zeros((1 << langid.SLOT_BITS, 1), np.uint8)
    slots[:] = 2
    hashes, _ = langid.ngrams(["some words"])
    for j in range(langid.HASHES):
        slots[(hashes >> np.uint64(langid.SLOT_BITS * j)) & np.uint64((1 << langid.SLOT_BITS) - 1)] |= 1
    filters = langid.Filters(["sparse", "full"], slots, 1)
    n, hits = langid.counted(filters, ["some words", "other things", "", "12"])
    assert hits[0].tolist() == [n[0], n[0]]
    assert langid.decide(filters, n, hits)[0] == ["sparse", "full", "und", "und"]


def test_held_out_languages(spark):
    ship_package(spark)
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), corpus(spark, MANY[:9])[0]):
        got = langid.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
        assert len(got) == docs.count()
        assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
        of_rest = [r.lang == r.lang_pred for r in got if r.held_out]
        assert sum(of_rest) >= 0.98 * len(of_rest)


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    ship_package(spark)
    df, _ = corpus(spark, ["a", "b"])
    base = langid.predict_languages(df).collect()
    odd = df.withColumn("lang", F.when(langid.is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    for name in ("h", "n", "language", "slot", "held_out", "score", "source"):
        odd = odd.withColumn(name, F.col("doc_id") % 3)
    assert sorted(langid.predict_languages(odd.repartition(3)).collect()) == sorted(base)


def test_odd_rows(spark):
    ship_package(spark)
    _, rows = corpus(spark, ["a", "b"])
    rows += [(9000 + i, t, None) for i, t in enumerate(AWKWARD)]
    rows += [(None, "abcabc", "c"), (None, None, "c"), (1, None, "a"), (1, "x", "b"), (1, "x", "b")]
    long = " ".join(t for _, t, x in rows if x == "b" and t) * 400
    assert len(long) > langid.CHUNK * 2 and len(long) > arrays.PIECE_BYTES
    got = langid.predict_languages(spark.createDataFrame([*rows, (7777, long, None)], SCHEMA)).collect()
    assert len(got) == len(rows) + 1
    texts = {(i, t) for i, t, _ in rows}
    for r in got:
        own = [t for i, t in texts if i == r.doc_id]
        assert r.held_out == held_out(r.doc_id) and r.lang_pred in ("a", "b", "und")
        if len(own) == 1:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in own[0] or ""))
    assert {r.lang_pred for r in got if r.doc_id == 7777} == {"b"}
    assert langid.predict_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    untaught = langid.predict_languages(spark.createDataFrame([(2, "abc", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in untaught] == [("und", 0.0)]


@pytest.mark.parametrize("text", ["x" * (langid.CHUNK + 5), "ab " * langid.CHUNK])
def test_chunks_are_the_text(text):
    parts = list(langid.chunks(text))
    assert "".join(parts) == text and all(len(p) <= langid.CHUNK for p in parts) and len(parts) > 1


def test_rare_languages_are_learned_in_any_number_of_passes(spark, monkeypatch):
    """A language of one text among 600 is predicted, and passes of few languages give what one pass gives."""
    ship_package(spark)
    _, rows = corpus(spark, ["a", "b", "c"], 200)
    ids = [i for i in range(5000, 5040) if not held_out(i)][:2]
    other = [i for i in range(6000, 6040) if held_out(i)][:2]
    texts = ["ζηθ ικλμ νξο πρσ τυφ", "жзи йклм ноп рст уфх"]
    rows += [(i, text, lang) for i, text, lang in zip(ids, texts, ("el", "ru"))] + [(i, text, None) for i, text in zip(other, texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(langid.predict_languages(df).collect())
    got = {r.doc_id: r.lang_pred for r in whole}
    assert [got[i] for i in ids + other] == ["el", "ru"] * 2
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 2)
    parts = sorted(langid.predict_languages(df).collect())
    assert [r[:3] for r in parts] == [r[:3] for r in whole]
    assert all(abs(x.score - y.score) < 1e-12 for x, y in zip(parts, whole))
