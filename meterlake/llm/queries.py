"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake.llm.align import align_documents
from meterlake.llm.ann import nearest, usable_vectors
from meterlake.llm.langid import predict_languages
from meterlake.llm.licenses import scan_licenses
from meterlake.llm.line_dedup import dedup_lines
from meterlake.llm.merkle import manifest
from meterlake.llm.near_dedup import classify
from meterlake.llm.packing import pack_documents
from meterlake.llm.shared import ship_package
from meterlake.llm.sql import ORACLE_SQL as ORACLE_SQL
from meterlake.llm.suffix_dedup import cut_repeats
from meterlake.llm.token_counts import count_tokens
from meterlake.llm.topk import integer_vectors, top_k
from meterlake.llm.toxicity import score_toxicity
from meterlake.llm.trie_bpe import round_trip


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "text", "lines_cut")


def op5_pstable_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "is_kept")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "text", "words_cut", "spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 2 divides the id's checksum, the line feeds of the text are gone, and the proof has to notice."""
    without_lines = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, without_lines)
    return manifest(table(spark, sf_dir, "documents"), tampered)


def op13_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_license_scan,
        op3_trie_bpe,
        op4_line_dedup,
        op5_pstable_ann,
        op6_token_counts,
        op7_probminhash_near_dedup,
        op8_suffix_dedup,
        op9_toxicity,
        op10_threshold_topk,
        op11_token_alignment,
        op12_merkle_manifest,
        op13_language_filters,
    )
}
