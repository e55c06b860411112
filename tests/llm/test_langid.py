import itertools
import random
import zlib

import numpy as np
import pytest
from frames import DOCUMENTS, documents, empty, result

from tidemark.llm import langid

WORDS = {"en": "the and thing with shore bread keeping", "de": "der und schein mit schule brot keiner", "fr": "le et chose avec eaux pain gardant"}


def slow_marginals(scores, moves):
    """Sum over all labellings of one chain."""
    length, labels = scores.shape
    total, out, pairs = 0.0, np.zeros_like(scores), np.zeros_like(moves)
    for path in itertools.product(range(labels), repeat=length):
        weight = np.exp(sum(scores[i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        total += weight
        for i, k in enumerate(path):
            out[i, k] += weight
        for a, b in itertools.pairwise(path):
            pairs[a, b] += weight
    return out / total, pairs / total


def test_forward_backward():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 1, 5, 4, 3])
    scores, moves = rng.normal(size=(lengths.sum(), 3)) * 2, rng.normal(size=(3, 3))
    out, pairs = langid.marginals(scores, moves, lengths)
    expected, sums, at = [], np.zeros((3, 3)), 0
    for length in lengths:
        one, moved = slow_marginals(scores[at:at + length], moves)
        expected.append(one)
        sums += moved
        at += length
    assert np.allclose(out, np.concatenate(expected)) and np.allclose(pairs, sums)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        language = rng.choice(list(WORDS))
        text = ". ".join(" ".join(rng.choice(WORDS[language].split()) for _ in range(8)) for _ in range(4))
        rows.append((i, text, language, "s", 1))
    return spark.createDataFrame(rows, DOCUMENTS)


def test_held_out(spark, corpus):
    model = langid.fit(corpus)
    assert model.languages == ["de", "en", "fr"]
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    held = [r for r in langid.identify(corpus, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 50 and all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 for r in held)


def test_held_out_labels_are_not_used(spark, corpus):
    from pyspark.sql import functions as F

    turned = corpus.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                              F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit(corpus), langid.fit(turned)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def test_code_switching(spark, corpus):
    model = langid.fit(corpus)
    given, _ = langid.Labeller(model).words(["the thing with bread schule keiner schein der brot chose avec eaux"])
    assert [model.languages[i] for i in given.argmax(axis=1)] == ["en"] * 4 + ["de"] * 5 + ["fr"] * 3


def test_batches_and_kept_words_do_not_matter(spark, corpus, monkeypatch):
    model = langid.fit(corpus)
    texts = [r.text for r in corpus.limit(40).collect()] + ["", None, "1234 ½² !?", "x" * 100_000, "the " * 500]
    whole = langid.Labeller(model).languages(texts)
    monkeypatch.setattr(langid, "_KEPT_WORDS", 5)
    small = langid.Labeller(model)
    assert [small.languages([t])[0][0] for t in texts] == [w[0] for w in whole]
    assert whole[40:43] == [("und", 0.0)] * 3 and whole[44][0] == "en"


def test_frames(spark, corpus):
    model = langid.fit(corpus)
    frame, wide = documents(spark), documents(spark, clashing=True)
    rows = langid.identify(frame, model).collect()
    assert len(rows) == frame.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2, 12}
    assert result(langid.identify(wide, model)) == result(langid.identify(frame, model))
    assert langid.identify(empty(spark), model).count() == 0
    unlearned = langid.fit(empty(spark))
    assert {(r.lang_pred, r.score) for r in langid.identify(frame, unlearned).collect()} == {("und", 0.0)}
