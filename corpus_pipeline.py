"""Corpus cleaning pipeline over ``documents``: five stages, each applied to all that the one before kept.

1. quality: documents that the classifier rejects go.
2. near_dedup: one document of each group of near duplicates stays (5-word shingles, Jaccard of 0.8 or more); rows that share
   a doc_id are documents of their own.
3. substring_dedup: words of 20-word passages that start earlier go from the texts.
4. decontaminate: documents that hold a benchmark item's question and answer go.
5. encode: the kept texts as byte-level BPE ids, verified by decoding.

Null and empty texts pass every filter unchanged; rows without doc_id are kept as they are; further columns are kept up
to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import bpe, decontaminate, minhash, quality, substring
from threadloom.llm.common import drop_path, materialize, prepare, scratch_path, table


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in ids; rows without doc_id stay."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def filter_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def dedup_near(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    if minhash.ids_repeat(docs):
        named = minhash.named_rows(docs)
        return named.join(materialize(minhash.dropped_rows(named, shingle_words=5), "near-duplicates"), minhash.ROW, "left_anti").select(docs.columns)
    dropped = materialize(minhash.near_duplicates(docs.select("doc_id", "text"), shingle_words=5).where("not kept").select("doc_id"), "near-duplicates")
    return _without(docs, dropped)


def dedup_substrings(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = substring.dedup_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def remove_benchmark(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.encode_documents(docs, *bpe.vocabulary())


STAGES = [
    ("quality", filter_quality),
    ("near_dedup", dedup_near),
    ("substring_dedup", dedup_substrings),
    ("decontaminate", remove_benchmark),
    ("encode", encode),
]

#: Classifier, MinHash and BPE can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
