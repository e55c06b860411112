"""Token counts kept up to date by signed changes.

A change inserts a document's count, deletes it, or revises it: takes the old count away and adds the new one. Counts add
up, so totals by source, language and tokenizer version are sums over committed batches. A batch is summed before it is
written, and written to a folder that names it and the attempt: the newest attempt that Spark has marked as finished
counts, so committing a batch again counts nothing twice, and a reader or a crash in between sees the one before.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import pick, stored
from tidemark.session import scratch_dir
from tidemark.sources.files import finished, folders

GROUP = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"

# What the two tokenizer versions count, as patterns.
WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]"


def number_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def inserts(rows: DataFrame) -> DataFrame:
    """Signed rows of documents that come in; ``rows`` has GROUP and n_tokens."""
    return rows.select(*GROUP, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Signed rows of documents that go, with the values under which they were counted."""
    return rows.select(*GROUP, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).cast("long").alias("n_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows of documents whose count, group or tokenizer changes."""
    return deletes(before).union(inserts(after))


def _attempts(spark: SparkSession, root: str, kind: str) -> dict[str, list[tuple[int, str]]]:
    """(attempt, path) of every write of a kind, finished or not, by name."""
    found: dict[str, list[tuple[int, str]]] = {}
    for folder in folders(spark, root):
        if folder.startswith(f"{kind}="):
            name, _, attempt = folder.removeprefix(f"{kind}=").rpartition(".")
            found.setdefault(name, []).append((int(attempt), os.path.join(root, folder)))
    return found


def _finished(spark: SparkSession, root: str, kind: str) -> dict[str, str]:
    """Path of the newest finished write of every name that has one."""
    newest = {name: [path for _, path in sorted(tried) if finished(spark, path)] for name, tried in _attempts(spark, root, kind).items()}
    return {name: paths[-1] for name, paths in newest.items() if paths}


def _next_path(spark: SparkSession, root: str, kind: str, name: str) -> str:
    tried = _attempts(spark, root, kind).get(name, [])
    return os.path.join(root, f"{kind}={name}.{max((n for n, _ in tried), default=-1) + 1}")


def _base(spark: SparkSession, root: str) -> tuple[str | None, set[str]]:
    """Path of the newest base, and the batches in it. A base counts once the list of its batches is stored."""
    listed = _finished(spark, root, "folded")
    if not listed:
        return None, set()
    newest = max(listed, key=int)
    names = spark.read.schema("batch string").parquet(listed[newest]).collect()  # a row per batch
    return _finished(spark, root, "base")[newest], {r.batch for r in names}


def commit(root: str, batch: str, changes: DataFrame) -> bool:
    """Sum a batch of signed rows and commit it under its name; returns whether it was taken.

    Committing a batch again, after a failure or by mistake, replaces it: the totals are the same as after once. One that
    is folded already is closed and stays as it is. Groups of which nothing is left over are not stored. NULL source,
    language or tokenizer are groups of their own; a NULL count adds no tokens. A batch without rows commits none.
    """
    spark = changes.sparkSession
    if batch in _base(spark, root)[1]:
        return False
    sums = changes.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"),
                                       F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
    sums = sums.filter("n_docs <> 0 or n_tokens <> 0")
    # One row per group and batch, whatever the number of documents.
    sums.coalesce(1).write.parquet(_next_path(spark, root, "batch", batch))
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals over all committed batches, without groups that are empty now. Reads the base and what is not in it."""
    base, folded = _base(spark, root)
    paths = [path for name, path in _finished(spark, root, "batch").items() if name not in folded]
    paths += [base] if base else []
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
        .filter("n_docs <> 0 or n_tokens <> 0")


def fold(spark: SparkSession, root: str) -> int:
    """Make a base of all batches committed so far, which closes them; returns how many it took in.

    Their totals do not change. Until the list of its batches is stored, the base is not used.
    """
    _, folded = _base(spark, root)
    new = sorted(set(_finished(spark, root, "batch")) - folded)
    if new:
        name = str(max((int(n) for n in _attempts(spark, root, "base")), default=-1) + 1)
        totals(spark, root).coalesce(1).write.parquet(_next_path(spark, root, "base", name))
        listed = spark.createDataFrame([(batch,) for batch in sorted(folded) + new], "batch string")
        listed.coalesce(1).write.parquet(_next_path(spark, root, "folded", name))
    return len(new)


def history(docs: DataFrame) -> DataFrame:
    """Totals after a history derived from ``docs``, with batches folded and one committed twice.

    All documents come in, counted in words. Those whose text another document of smaller id has are deleted. The
    rest are counted anew in pieces; where that gives another count, the document is revised to it.

    NULL text counts as the empty one. Documents without id are no copies of others, nor are repeated rows of one id.
    Texts are counted whole, whatever their length; other columns play no part, and an empty table gives no totals.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = pick(docs, **{c: c for c in ("doc_id", "source", "lang", "text")})
    counted = stored(docs.select("doc_id", "source", "lang", number_of(F.col("text"), WORDS).alias("words"),
                                 number_of(F.col("text"), PIECES).alias("pieces"),
                                 F.sha2(text.cast("binary"), 256).alias("digest")), "token-counts")
    # The join is by id, not by text: a text of very many documents is one row among the first ones.
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = counted.join(first, ["doc_id", "digest"], "left").select(
        "source", "lang", "words", "pieces", (F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("copy"))
    marked = stored(marked, "token-copies")

    def as_words(rows: DataFrame) -> DataFrame:
        return rows.select("source", "lang", F.lit("words-1").alias("tokenizer"), F.col("words").alias("n_tokens"))

    def as_pieces(rows: DataFrame) -> DataFrame:
        return rows.select("source", "lang", F.lit("pieces-1").alias("tokenizer"), F.col("pieces").alias("n_tokens"))

    copies = marked.filter("copy")
    revised = marked.filter("not coalesce(copy, false) and words <> pieces")
    root = scratch_dir(spark, "token-rollups")
    commit(root, "0001", inserts(as_words(marked)))
    commit(root, "0002", deletes(as_words(copies)))
    fold(spark, root)
    commit(root, "0003", revisions(as_words(revised), as_pieces(revised)))
    commit(root, "0002", deletes(as_words(copies)))
    commit(root, "0003", revisions(as_words(revised), as_pieces(revised)))
    return totals(spark, root)
