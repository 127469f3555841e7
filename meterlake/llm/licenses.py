"""License scans by diagonal voting.

A text that quotes a license template shares word k-grams with it at a constant offset. All rolling
k-gram hashes of all texts are joined to the positions they have in the templates. Hits are counted by
diagonal, that is text position minus template position. Neighbouring diagonals, which a
missing or added word tears apart, are merged, and a span counts if it covers
enough of its template.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterlake.llm import arrays

K = 2
#: Diagonals this far apart belong to one span.
DRIFT = 2
#: Share of a template's k-grams that a span must cover. Short templates differ from
#: each other by single words, so they must be covered whole.
COVERAGE = 0.7
SHORT = 8

# The phrases every scan looks for, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wordings that name a license in other ways: text and label.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("bsd 3 clause license", "bsd"),
    ("mozilla public license version 2 0", "mpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution share alike", "cc-by-sa"),
    ("creative commons attribution non commercial", "cc-by-nc"),
    ("released into the public domain", "public-domain"),
    ("this is free and unencumbered software released into the public domain", "public-domain"),
    ("all rights reserved", "proprietary"),
]

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_DOCUMENT = 0  # hash that stands for the text itself, so that every text has a row


def rolling(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """k-gram hashes, index of the first word of each, text of each word, and begin of each text's words."""
    data = LOWER[data]
    starts, ends, owner = arrays.runs(WORD[data], offsets)
    hashes, first = arrays.grams(arrays.span_hashes(data, starts, ends), owner, k)
    return arrays.as_long(hashes), first, owner, arrays.bounds(owner, len(offsets) - 1)


def template_positions(spark, base: dict[str, str], templates: list[tuple[str, str]], k: int) -> DataFrame:
    """k-gram positions of all templates: as many rows as the templates given have words."""
    rows = [(_DOCUMENT, -1, 0, 0, "", False)]
    named = [(text, label, True) for text, label in base.items()] + [(t, label, False) for t, label in templates]
    for number, (text, label, is_base) in enumerate(named):
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, first, _, _ = rolling(raw, np.array([0, len(raw)]), k)
        if not len(hashes):
            raise ValueError(f"a template needs {k} words: {text!r}")
        rows += [(int(h), number, int(i), len(hashes), label, is_base) for h, i in zip(hashes, first)]
    return spark.createDataFrame(
        rows, "gram long, template int, at long, grams int, label string, is_base boolean"
    )


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    base: dict[str, str] = BASE,
    coverage: float = COVERAGE,
    drift: int = DRIFT,
    with_spans: bool = False,
) -> DataFrame:
    """License phrases and wordings of every text.

    Returns one row for each row of docs: doc_id, n_words, n_base (places of base phrases, all their words
    in a row), first_word and last_word (smallest and largest start of such a place, null if none), base_labels,
    labels (with those of the templates), score (largest share of a template that a span covers, 0 to 1), and
    on request the spans. A null text has no words. Repeated rows and null ids stay. Other columns aren't carried.
    The templates given are the only data broadcast.
    """

    def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches):
            data, offsets = arrays.column_bytes(batch.column("text"))
            grams, first, owner, begin = rolling(data, offsets, K)
            n = np.diff(begin)
            each = np.bincount(owner[first], minlength=len(n)).astype(np.int64)
            ends = np.cumsum(each + 1)  # one more for the text itself
            out = np.full(int(ends[-1]), _DOCUMENT, np.int64)
            out[np.arange(len(grams)) + owner[first] + 1] = grams
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n), lists], names=["row", "doc_id", "n_words", "grams"]
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    hashed = rows.mapInArrow(hash_words, "row long, doc_id long, n_words long, grams array<long>")
    # Position 0 is the text itself, so the k-gram of word i stands at i + 1.
    grams = hashed.select("row", "doc_id", "n_words", F.posexplode("grams").alias("place", "gram"))
    known = template_positions(docs.sparkSession, base, templates, K)
    hits = grams.join(F.broadcast(known), "gram").where("template >= 0 or place = 0")
    diagonals = hits.groupBy("row", "template", (F.col("place") - 1 - F.col("at")).alias("diagonal")).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("grams").alias("grams"),
        F.first("label").alias("label"),
        F.first("is_base").alias("is_base"),
        F.collect_set("at").alias("covered"),
        F.min(F.col("place") - 1).alias("begin"),
        F.max(F.col("place") - 1 + K).alias("end"),
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    # Base phrases count where they stand word for word, so their diagonals are never merged.
    apart = F.col("is_base") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > drift, F.lit(True))
    spans = (
        diagonals.withColumn("span", F.sum(apart.cast("int")).over(order))
        .groupBy("row", "template", "span")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.first("label").alias("label"),
            F.first("is_base").alias("is_base"),
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
            F.min("diagonal").alias("diagonal"),
            F.first("grams").alias("grams"),
            (F.size(F.array_distinct(F.flatten(F.collect_list("covered")))) / F.first("grams")).alias("share"),
        )
        .withColumn("share", F.when(F.col("template") < 0, 0.0).otherwise(F.col("share")))
    )
    place = F.when(F.col("is_base") & (F.col("share") == 1), F.col("diagonal"))
    least = F.when(F.col("is_base") | (F.col("grams") < SHORT), 1.0).otherwise(coverage)
    found = F.when(F.col("share") >= least, F.col("label"))
    result = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(place).alias("n_base"),
        F.min(place).alias("first_word"),
        F.max(place).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(place.isNotNull(), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(found)), ",").alias("labels"),
        F.max("share").alias("score"),
        *(
            [F.sort_array(F.collect_list(F.when(found.isNotNull(), F.struct("begin", "end", "label", "share")))).alias("spans")]
            if with_spans
            else []
        ),
    )
    return result.drop("row")
