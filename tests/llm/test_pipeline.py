"""The pipeline's stages one by one and together."""

import zlib

import corpus_pipeline
from llm_making import SF, odd_documents
from tokenizers import Tokenizer

from meterlake.llm import queries
from meterlake.llm.shared import settled
from meterlake.llm.toxicity import score_toxicity


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    counts = [docs.count()]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = settled(stage(spark, now, SF))
        assert now.dtypes == docs.dtypes
        counts.append(now.count())
        if name == "toxicity":
            kept = {r.doc_id for r in score_toxicity(docs, labels).where("score < 0.5").collect()}
            assert {r.doc_id for r in now.collect()} == kept
    assert counts[1] == counts[2] > counts[3] == counts[4]
    assert now.where("text is not null and n_chars <> length(text)").count() == 0
    texts = {r.doc_id: r.text for r in now.collect()}
    placed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    encode = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json")).encode
    for r in placed:
        ids = [*encode(texts[r.doc_id], add_special_tokens=False).ids, 2][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    assert {r.doc_id for r in placed} == set(texts)
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, placed))


def test_stages_take_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    for df in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, SF).columns == odd.columns
            stage(spark, df, SF).count()
        corpus_pipeline.STAGES[-1][1](spark, df, SF).count()
