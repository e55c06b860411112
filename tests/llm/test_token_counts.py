import os
import re
from collections import Counter

from frames import documents, empty, result
from pyspark.sql import functions as F

from tidemark.llm import token_counts as T
from tidemark.session import scratch_dir

ROWS = "source string, lang string, tokenizer string, n_tokens long"


def rows(spark, data):
    return spark.createDataFrame(data, ROWS)


def test_changes_add_up(spark):
    root = scratch_dir(spark, "rollup")
    first = rows(spark, [("a", "en", "v1", 5), ("a", "en", "v1", 7), ("b", None, "v1", 1), (None, "en", "v1", None)])
    T.commit(root, "1", T.inserts(first))
    T.commit(root, "2", T.deletes(rows(spark, [("a", "en", "v1", 5)])))
    T.commit(root, "3", T.revisions(rows(spark, [("a", "en", "v1", 7)]), rows(spark, [("a", "en", "v2", 9)])))
    expected = {("a", "en", "v2", 1, 9), ("b", None, "v1", 1, 1), (None, "en", "v1", 1, 0)}
    assert {tuple(r) for r in T.totals(spark, root).collect()} == expected
    # Batches again, in any order, change nothing.
    for name, changes in (("2", T.deletes(rows(spark, [("a", "en", "v1", 5)]))), ("1", T.inserts(first))):
        T.commit(root, name, changes)
    assert {tuple(r) for r in T.totals(spark, root).collect()} == expected
    T.commit(root, "4", T.inserts(rows(spark, [])))
    assert {tuple(r) for r in T.totals(spark, root).collect()} == expected


def test_unfinished_and_folded_batches(spark):
    root = scratch_dir(spark, "rollup")
    assert T.totals(spark, root).count() == 0 and T.fold(spark, root) == 0
    one, two = rows(spark, [("a", "en", "v1", 5)]), rows(spark, [("b", "en", "v1", 7)])
    T.commit(root, "day.1", T.inserts(one))
    T.commit(root, "day.2", T.inserts(two))
    expected = {("a", "en", "v1", 1, 5), ("b", "en", "v1", 1, 7)}
    # An attempt that died: its files are there, but Spark did not mark it as finished.
    T.commit(root, "day.2", T.inserts(rows(spark, [("b", "en", "v1", 99)])))
    os.remove(f"{root}/batch=day.2.1/_SUCCESS")
    assert {tuple(r) for r in T.totals(spark, root).collect()} == expected
    assert T.fold(spark, root) == 2 and T.fold(spark, root) == 0
    assert {tuple(r) for r in T.totals(spark, root).collect()} == expected
    assert not T.commit(root, "day.1", T.inserts(two)) and T.commit(root, "day.3", T.deletes(two))
    assert {tuple(r) for r in T.totals(spark, root).collect()} == {("a", "en", "v1", 1, 5)}
    assert T.fold(spark, root) == 1
    os.remove(f"{root}/folded=1.0/_SUCCESS")  # a fold that died: the one before it and the batch after count
    assert {tuple(r) for r in T.totals(spark, root).collect()} == {("a", "en", "v1", 1, 5)}
    assert T.fold(spark, root) == 1 and {tuple(r) for r in T.totals(spark, root).collect()} == {("a", "en", "v1", 1, 5)}


def test_history_equals_recount(spark):
    frame = documents(spark)
    texts = {}
    counts = Counter()
    for row in sorted(frame.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        text = row.text or ""
        if text in texts and row.doc_id is not None and row.doc_id > texts[text]:
            continue
        texts.setdefault(text, row.doc_id)
        words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        import regex
        pieces = len(regex.findall(r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]", text))
        key = (row.source, row.lang, "words-1" if words == pieces else "pieces-1")
        counts[key] += 1
        counts[(*key, "tokens")] += pieces
    expected = {(*k, n, counts[(*k, "tokens")]) for k, n in counts.items() if len(k) == 3}
    assert {tuple(r) for r in T.history(frame).collect()} == expected


def test_frames(spark):
    assert result(T.history(documents(spark, clashing=True))) == result(T.history(documents(spark)))
    assert T.history(empty(spark)).count() == 0
    found = documents(spark).select(T.number_of(F.col("text"), T.WORDS).alias("n")).collect()
    assert found[0].n == 0 and max(r.n for r in found) == 20_000
