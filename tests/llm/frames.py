"""Small tables with every awkward case that the operators define a result for."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use inside or give out; a table may have them already.
CLASHING = ("TEXT", "score", "kept", "spans", "component_id", "fingerprint", "position", "whole", "at", "id", "label",
            "toxic", "rule", "n_words", "language", "mixed_id", "kept_id", "ids")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8))) for _ in range(words))


def awkward_texts() -> list[str | None]:
    return [None, "", " \n\t ", "word", "two words", prose(1, 60), prose(1, 60), prose(2, 20_000), "é" * 5000,
            "naïve İstanbul ΑΣ\x1cx\x85y z", "<|endoftext|>a<|startoftext|>", "a\n\n\na\nb", "!?;:​"]


def documents(spark, texts=None, clashing=False):
    texts = awkward_texts() if texts is None else texts
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "no id", None, None, None)]  # a repeated row, and NULLs in every other column
    frame = spark.createDataFrame(rows, DOCUMENTS)
    if clashing:
        extra = [*frame.columns, *CLASHING]
        frame = spark.createDataFrame([(*r, *range(len(CLASHING))) for r in rows],
                                      T.StructType([*DOCUMENTS, *[T.StructField(c, T.LongType()) for c in CLASHING]]))
        assert frame.columns == extra
    return frame


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def result(df) -> list[tuple]:
    return sorted(map(repr, map(tuple, df.collect())))
