"""License scans and toxicity against plain Python and held-out labels."""

import re
import zlib

from llm_making import AWKWARD, SF, documents, odd_documents, texts_of

from meterlake.llm import licenses, queries
from meterlake.llm.shared import ship_package
from meterlake.llm.toxicity import drop_toxic, fit_toxicity, held_out, score_toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSES = [
    "Released under the MIT License. MIT-license; mit   LICENSE", "the Apache\nLicense and the GNU General Public License",
    "general public licenses", "mit", "license mit license", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0",
    "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this Software", "All rights reserved",
    "mit license " * 300,
]


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lower)


def test_base_phrases_equal_a_plain_search(spark):
    ship_package(spark)
    texts = {**texts_of(spark), **{10_000 + i: t for i, t in enumerate(AWKWARD + LICENSES)}}
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, [*texts.items()]).repartition(3)).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        w, places, labels = words(text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places)), i
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not places)


def test_templates_and_their_spans(spark):
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, [*enumerate(LICENSES)]), with_spans=True).collect()}
    assert [rows[i].labels for i in range(9)] == ["mit", "apache,gpl", "", "", "mit", "cc-by-nc", "cc-by", "mit", "proprietary"]
    span = rows[7].spans[0]  # one word more than the template: two diagonals, one span
    assert (span.begin, span.end) == (0, len(words(LICENSES[7])))


def test_licenses_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert licenses.scan_licenses(odd).count() == odd.count()
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.QUERIES["op9_toxicity"](spark, sf).collect()
    assert len(scored) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in scored)
    assert all(r.predicted == int(r.score >= 0.5) for r in scored)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    both = [(r.score, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, t in both if t], [s for s, t in both if not t]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) > 0.95


def test_held_out_labels_and_other_columns_are_never_read(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id").cast("string"))
    first, second = ({r.doc_id: r.score for r in score_toxicity(*x).collect()} for x in ((docs, labels), (other, changed)))
    assert first == second


def test_toxicity_of_odd_tables(spark):
    odd = odd_documents(spark)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    assert score_toxicity(odd, labels).count() == odd.count()  # no usable label: a constant
    assert fit_toxicity(odd, labels).trees is None
    mixed = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    assert score_toxicity(odd, mixed).count() == odd.count()
    assert score_toxicity(odd.limit(0), mixed).count() == 0
    kept = drop_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()
