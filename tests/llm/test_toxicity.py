import random
import zlib

import pytest
from frames import DOCUMENTS, documents, empty, prose, result

from tidemark.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = {"idiot": 5.0, "scum": 4.0, "pathetic": 6.0, "worthless": 3.0, "idiots": 2.0, "réeux*": 1.0}
    lexicon = toxicity.FuzzyLexicon(terms)
    rng = random.Random(4)
    for _ in range(4000):
        word = list(rng.choice([t.rstrip("*") for t in terms]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(word))
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "i", "t", "oo"])
        word = "".join(word)
        matches = [(d, -w, t) for t, w in terms.items() if not t.endswith("*")
                   and (d := distance(word, t)) <= toxicity.edits_for(t)]
        matches += [(0, -w, t) for t, w in terms.items() if t.endswith("*") and word.startswith(t[:-1])]
        found = lexicon.find(word)
        if not matches:
            assert found is None, word
        else:
            assert (found[1], -found[0]) == min(matches)[:2], word


def test_context():
    scorer = toxicity.Scorer(toxicity.Model({"idiot": 5.0, "pathetic": 5.0}, [0.0] * 7))
    direct, addressed, misspelled, quoted, *_ = scorer.features("you are an idiot")
    assert direct > 0 and addressed > 0 and not misspelled and not quoted
    assert scorer.features('the word "idiot" was used')[3] > 0 and scorer.features('the word "idiot" was used')[0] == 0
    assert scorer.features("such a patetic thing")[2] > 0
    assert scorer.features("1d10t!")[0] > 0 and scorer.features("") == [0.0] * 6


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words, bad = prose(i, 60).split(), int(rng.random() < 0.3)
        if bad:
            for term in rng.sample(["idiot", "scum", "pathetic"], 2):
                words.insert(rng.randint(0, 60), term)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, bad))
    return spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    assert {"idiot", "scum", "pathetic"} <= set(model.terms)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in held) / len(held) > 0.97
    kept = toxicity.reject_toxic(docs, model)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    # Labels of held-out documents are not used.
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                               1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, turned) == model


def test_frames(spark, labelled):
    model = toxicity.fit(*labelled)
    frame = documents(spark)
    scores = toxicity.score(frame, model).collect()
    assert len(scores) == frame.count() and all(0 <= r.score <= 1 for r in scores)
    wide = documents(spark, clashing=True)
    assert result(toxicity.score(wide, model)) == result(toxicity.score(frame, model))
    assert toxicity.reject_toxic(wide, model).columns == wide.columns
    assert toxicity.score(empty(spark), model).count() == 0 and toxicity.reject_toxic(empty(spark), model).count() == 0


def test_one_class_or_none(spark, labelled):
    docs, labels = labelled
    for given in (labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.fit(docs, given)
        scores = {r.score for r in toxicity.score(docs, model).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 0.5
    doubled = labels.union(labels).union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    assert toxicity.fit(docs, doubled).terms == toxicity.fit(docs, labels).terms
