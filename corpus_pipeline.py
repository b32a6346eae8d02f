"""A corpus from documents: identified, without near duplicates, without personal data, mixed, and encoded.

STAGES are applied in order; each gets what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.langid import keep_identified
from graphloom.llm.mixing import mixed_documents
from graphloom.llm.pii import redact_documents
from graphloom.llm.sentencepiece_bpe import encode_decode
from graphloom.llm.session import bounded_batches, forget, stored
from graphloom.llm.simhash import keep_one


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    bounded_batches(spark)
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    bounded_batches(spark)
    return keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    bounded_batches(spark)
    return redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in the order of its schedule."""
    bounded_batches(spark)
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (comma-joined), their number, and digests of the ids and of the decoded text."""
    import public_tokenizers

    bounded_batches(spark)
    found = encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    told = found.withColumn("token_ids", F.array_join(F.col("ids").cast("array<string>"), ","))
    return told.select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2(F.col("token_ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: The stages fit a classifier, hash with XXH64 and encode with a vocabulary file: SQL doesn't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir.

    What a stage keeps is stored in the checkpoint folder, read by the next one, and
    deleted once that one's result is stored. The last stored table stays, since the
    result is read from it.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs, path = stored(docs)
            if before:
                forget(spark, before)
            before = path
    return docs
