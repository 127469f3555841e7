"""From raw documents to packed training sequences.

Every stage takes the documents its predecessor kept and works on all of them. Stages may be run one by one, with
their results written and read again, or together by `run`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake.llm.line_dedup import dedup_lines
from meterlake.llm.near_dedup import keep_one
from meterlake.llm.packing import pack_documents
from meterlake.llm.queries import table, tokenizer_path
from meterlake.llm.shared import settled, ship_package
from meterlake.llm.suffix_dedup import cut_repeats
from meterlake.llm.toxicity import drop_toxic


def with_new_text(cut: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from `row`, with the new `text` and its length in n_chars."""
    columns = []
    for field in docs.schema.fields:
        column = F.col("row")[field.name]
        if field.name == "text":
            column = F.col("text")
        elif field.name == "n_chars":
            same = F.col("row")["text"].eqNullSafe(F.col("text"))
            column = F.when(same, column).otherwise(F.length("text").cast(field.dataType))
        columns.append(column.alias(field.name))
    return cut.select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; rejected ones go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines stays; no document goes."""
    ship_package(spark)
    return with_new_text(dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship_package(spark)
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of passages that repeat, the first stays; no document goes."""
    ship_package(spark)
    return with_new_text(cut_repeats(docs), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of the remaining documents stands in the packed sequences."""
    ship_package(spark)
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is kept in the shared folder once made."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models, string similarity and union-find are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
