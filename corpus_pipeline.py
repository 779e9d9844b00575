"""A corpus prepared in four stages: good documents, one of each near-duplicate group, none that holds a
benchmark item, as token ids.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the docs of the
next. All but the last return the columns of the table documents. An empty table gives empty results, texts of any
length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.llm import byte_bpe, decontaminate, quality, simhash
from cardlens.llm.common import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network, trained on the labels that are not held out, does not reject.

    A null text is judged as an empty one, rows that repeat a document alike; columns stay, whatever their names.
    """
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, net, least=0.3)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked fingerprints.

    Null and empty texts are linked like any others; where all ids are null, the smallest text hash decides; of rows
    that repeat id and text, one stays.
    """
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or paraphrased. Null and empty texts hold none."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, packed, and whether they decode to its text. A null text has no ids."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    given = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return byte_bpe.encode_and_decode(given, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"), "ids",
    )


STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicates", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", token_ids),
]
# Training, components and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
