"""Small tables for the operators: awkward texts, and rows with nulls, repeats and odd columns."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

AWKWARD = [
    None, "", " ", "\n", "\n\n x", "a", "  x  y ", "it's I'll we've ''s !'s 's\n's x's's 'st", "don't\tstop 12's",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|startoftext|>Hi<|endoftext|", "aaaaaaaaaaaaaa",
    "日本語 テスト ñandú éàü ½²³ ٣", "😀😀 a😀'll", "​\u0085x  y", "ΑΣ ΌΣΟΣ Σ", "İstanbul ǅ ﬁ é Ω", "'", "'l", "'re",
    "x" * 3000, "ab" * 900, "word " * 2500,
]


def documents(spark, rows, extra=()):
    """(doc_id, text) rows; `extra` names further columns that hold the text's length as text."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in extra:
        df = df.withColumn(name, F.length("text").cast("string"))
    return df


def odd_documents(spark):
    """Nulls, repeats, ties and columns named like those the operators make."""
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, None), (None, "a"), (5, "a"), (5, "a"), (5, "other")]
    return documents(spark, rows, ("row", "r1", "score", "label", "key", "gone", "features", "may", "k1", "at"))


def texts_of(spark, sf=SF):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
