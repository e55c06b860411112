"""From raw documents to token ids: drop toxic texts, drop near copies, redact secrets, mix sources, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written before the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, queries, secrets, simhash, toxicity
from tidemark.llm.common import pick
from tidemark.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a model fitted to labelled ones among them."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, queries.table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.keep_one(docs, queries.SHINGLE, queries.DISTANCE)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets are replaced by their kind, and n_chars follows."""
    return secrets.redact(docs, length="n_chars")


def in_mixture_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources alternate by their target weights."""
    return mixing.mixed(docs, queries.WEIGHTS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the codes and of what they decode to, and slot and position in the mixture.

    Files do not keep the order of rows, so the place is given with each row: it follows from ids and sources alone.
    Rows that share an id share their first place; rows without id have none.
    """
    named = pick(docs, doc_id="doc_id", source="source").filter("doc_id is not null")
    places = mixing.mix(named, queries.WEIGHTS).groupBy("doc_id") \
        .agg(F.min("slot").alias("slot"), F.min("position").alias("position"))
    return bpe.digests(bpe.transcode(docs, queries.VOCABULARY)).join(places, "doc_id", "left")


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_copies),
    ("secret_scans", without_secrets),
    ("mixing", in_mixture_order),
    ("bpe", as_tokens),
]

#: Learned scores, fingerprints over hashes and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
