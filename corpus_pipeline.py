"""A corpus pipeline: toxicity, quality, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet to the shared folder and read
again as the next stage's docs. Rows come as in ``documents`` until the last stage, which returns
doc_id, source, n_tokens, ids and decoded_sha256 of every document of the mix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndspark.llm import bpe, mixing, rules, setsketch, toxicity
from ndspark.llm.common import shared, table
from ndspark.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; shingles of five words, similarity 0.8. Rows without or with equal ids are compared like all."""
    return setsketch.one_of_each(docs, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = docs.select(F.struct("doc_id", "source").alias("row"), "text")
    done = bpe.encode(both, VOCABULARY, public_tokenizers.PATTERN, key="row")
    return done.select("row.doc_id", "row.source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    place = f"{shared(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{k}")
        docs = spark.read.parquet(f"{place}/{k}")
    return docs


#: Trained classifiers and the tokenizer's recursion are beyond plain SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None
