"""The operators of this folder as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidemark.llm import (bpe, divergence, embeddings, langid, mixing, quality, secrets, simhash, suffixes,
                          token_counts, toxicity, url_filter, whitening)

#: Vocabulary of the BPE query and of the pipeline's last stage.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Words in a shingle and greatest number of differing bits of the SimHash query and stage.
SHINGLE, DISTANCE = 3, 2
#: Target weights of the mixture: two sources get more than the others, which share the rest.
WEIGHTS = {"src0": 0.1, "src1": 0.15}

#: Rules of the URL filter query.
RULES = (url_filter.Rule("allow", "com"), url_filter.Rule("block", "example.com", "/en/"),
         url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
         url_filter.Rule("block", "net", "/fr/"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS)


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.history(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return langid.identify(docs, langid.fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.transcode(table(spark, sf_dir, "documents"), VOCABULARY))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents"), 50))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_mixing, op2_embeddings, op3_quality, op4_token_counts, op5_simhash, op6_secrets, op7_toxicity,
             op8_url_filter, op9_language, op10_bpe, op11_suffix_dedup, op12_divergence,
             op13_whitening)
    return {query.__name__: query for query in named}
