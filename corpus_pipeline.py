"""The corpus pipeline: toxic documents go, one of each group of near copies stays, leaked test items go, the rest is
sampled to target weights and written as token ids.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
docs. All stages but the last return the columns they get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import decontaminate, mixing, order_minhash, token_ids, toxicity
from seqloom.llm.common import staged

THRESHOLD = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model, learnt from the labelled ones among docs, scores below the threshold.

    Null and empty texts are scored as empty and, like those without a doc_id, are kept if that score is below it; very
    long ones are scored whole. Equal rows share their fate and each stays. Labels of other documents count for nothing;
    without both labels every score is that of the labels' share. No documents give none. All columns stay.
    """
    model = toxicity.fit(docs.select("doc_id", "text"), toxicity.labelled(spark, sf_dir))
    return toxicity.keep_harmless(docs, model, THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near copies.

    Null and empty texts are one class. Different texts under one doc_id, or without one, are told apart; of those that
    share a class and its least doc_id the one of the least digest stays, and of equal rows one. Very long texts are
    compared whole. No documents give none. All columns stay, whatever their names.
    """
    return order_minhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark.

    Null and empty texts hold none and stay; null and empty items are in none. Very long texts are read whole. Equal rows
    share their fate and each stays, as do rows without a doc_id. No documents give none, and no items let all stay. All
    columns stay.
    """
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sample_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic weights are near their targets; decided by document.

    Documents without words, so null and empty ones, weigh nothing and stay. A null source or language counts as an empty
    one. Rows of one doc_id, and all without one, share a random number, so equal rows share their fate. Very long texts
    count with all their words. No documents give none. All columns stay, whatever their names.
    """
    return mixing.keep_sampled(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read from the shards just written.

    A null text counts as empty and has the end id alone. Repeated rows are documents of their own, in the order of their
    texts' hashes; rows without a doc_id come first. Very long texts are encoded whole. No documents give none.
    """
    return token_ids.encode_corpus(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", sample_to_weights),
    ("token_ids", write_token_ids),
]

#: Models, sketches and tokenizers are beyond SQL; the pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
