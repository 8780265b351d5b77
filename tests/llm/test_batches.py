"""Long texts go to Python in small batches, whatever the session's own setting."""

import public_tokenizers
from pyspark.sql import functions as F

from nestmetrics.llm import packing, toxicity
from nestmetrics.llm.bpe import WORD_BPE

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _watch(monkeypatch, module, spark):
    seen, plain = {}, module.stored

    def stored(df, label):
        seen[label] = int(spark.conf.get(KEY))
        return plain(df, label)

    monkeypatch.setattr(module, "stored", stored)
    return seen


def test_texts_are_packed_and_scored_in_small_batches(spark, tmp_path, monkeypatch):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some plain words "), F.col("id").cast("string")).alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get(KEY)
    packed = _watch(monkeypatch, packing, spark)
    assert packing.pack_documents(docs, public_tokenizers.path(WORD_BPE)).count() == 2000
    scored = _watch(monkeypatch, toxicity, spark)
    assert toxicity.op8_toxicity(spark, str(tmp_path)).count() == 2000
    kept = toxicity.drop_toxic(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert kept.columns == docs.columns
    assert packed["pieces"] == scored["scores"] == scored["training"] == scored["not-toxic"] == 500
    assert spark.conf.get(KEY) == before
