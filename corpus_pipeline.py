"""A corpus, from documents to token ids, in stages that each call one operator of claimwright.llm.

Each stage gets what the one before it kept, written as Parquet and read again; all but the last return the
columns of documents. Rows in, rows out:

  quality    documents that the ranking model rejects go; labels are those of the corpus folder
  exact      one row of each different text stays, the one with the largest doc_id
  near       one row of each group of near copies stays, the one with the smallest doc_id
  mix        documents are repeated or left out so that sources reach their target weights
  encode     a row per document of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids themselves

Null and empty texts are texts like any other in every stage; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimwright.llm import automaton, common, exact, mixing, quality, simhash
from claimwright.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SHINGLE, MOST_BITS = 3, 3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return quality.accepted(docs, common.table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return exact.without_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return simhash.one_of_each(docs, shingle=SHINGLE, most=MOST_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return mixing.repeated(docs, weights=WEIGHTS, share=1.0, most=float(MOST_COPIES))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return automaton.encoded(docs, tokenizer("word_bpe_49k.json")).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality), ("exact", drop_exact), ("near", drop_near), ("mix", mix_sources), ("encode", encode),
]

#: The learned model and the fingerprints have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.ship(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
