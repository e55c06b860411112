"""Toxicity scores from a learned lexicon, matched with spelling errors, and the words around each match.

Terms (words and stems) are learned from labelled documents. The lexicon is a trie; the Levenshtein automata of its
terms run on it together: a state is the set of (trie node, edits so far) that the letters read so far can reach, and
each transition is worked out once and kept. Most words leave the automaton after three or four letters.

Each match is weighed by a window of words around it. Quotation marks, words of reporting and of denial speak for
quotation, address to the reader speaks for abuse. A logistic model over sums of these decides.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Kept, column, map_batches, map_whole_rows, pick, stored

#: Labelled documents per class from which a model is fitted, those of smallest hash.
SAMPLE_PER_CLASS = 3000
#: Terms in a lexicon.
MOST_TERMS = 400
#: Words on each side of a match that decide how it is meant.
WINDOW = 8
_KEPT_WORDS = 100_000
_KEPT_STEPS = 500_000
_STEM_LENGTHS = (4, 5, 6, 7, 8)

# Words that stand next to quoted or denied terms, and words that address somebody.
REPORTING = frozenset(
    "said says say called calls call calling word words term terms quote quoted quotes wrote writes mentions mention "
    "saying used using meaning means definition dictionary heißt sagte nannte wort zitat begriff dit mot appelé "
    "citation dijo palabra llamó cita término not never isn't don't nicht pas nunca".split())
ADDRESS = frozenset("you your you're youre u ur yourself du dich dein ihr tu toi vous te tú usted".split())
_QUOTES = "\"“”„«»‹›‘"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SWAPS = str.maketrans("0134578@$", "oieastbas")


def edits_for(term: str) -> int:
    """Spelling errors that a term of this length may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class FuzzyLexicon:
    """Trie of terms and the automaton that accepts their misspellings.

    ``terms``: weight by term; a term that ends in * is a stem, which must be spelled right and may be followed by
    anything, as must the terms in ``exact``. ``find`` gives (weight, edits, term) of the best match: the fewest
    edits, then the greatest weight.
    """

    def __init__(self, terms: dict[str, float], exact: frozenset[str] = frozenset()):
        self.children: list[dict[str, int]] = [{}]
        self.room = [0]
        self.whole: dict[int, tuple[float, int, str]] = {}
        self.stems: dict[int, tuple[float, str]] = {}
        for term, weight in sorted(terms.items()):
            stem = term.endswith("*")
            letters = term[:-1] if stem else term
            allowed = 0 if stem or term in exact else edits_for(letters)
            node = 0
            self.room[0] = max(self.room[0], allowed)
            for letter in letters:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], allowed)
            if stem:
                self.stems[node] = (weight, term)
            else:
                self.whole[node] = (weight, allowed, term)
        self.letters = {letter for node in self.children for letter in node}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """Number of a state after letters of the lexicon that the word leaves out, each one edit."""
        queue = list(reached)
        while queue:
            node = queue.pop()
            cost = reached[node] + 1
            for child in self.children[node].values():
                if cost <= self.room[child] and cost < reached.get(child, 99):
                    reached[child] = cost
                    queue.append(child)
        key = frozenset(reached.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.room[node] and cost < reached.get(node, 99):
                reached[node] = cost

        for node, cost in self.sets[state]:
            reach(node, cost + 1)
            for label, child in self.children[node].items():
                reach(child, cost if label == letter else cost + 1)
        return self._state(reached) if reached else -1

    def find(self, word: str) -> tuple[float, int, str] | None:
        best, state, steps = None, self.start, self.steps
        for letter in word:
            if letter not in self.letters:
                letter = ""
            following = steps.get((state, letter))
            if following is None:
                if len(steps) > _KEPT_STEPS:
                    steps.clear()
                following = steps[state, letter] = self._step(state, letter)
            if following < 0:
                return best
            state = following
            if self.stems:
                for node, cost in self.sets[state]:
                    if cost == 0 and node in self.stems:
                        best = max(best or (0.0, 0, ""), (self.stems[node][0], 0, self.stems[node][1]))
        for node, cost in self.sets[state]:
            if node in self.whole and cost <= self.whole[node][1]:
                found = (self.whole[node][0], cost, self.whole[node][2])
                if best is None or (-found[1], found[0]) > (-best[1], best[0]):
                    best = found
        return best


def letters_of(word: str) -> str:
    """A word without its edges of punctuation, in lower case, with digits and signs that stand for letters undone."""
    plain = _EDGE.sub("", word.lower())
    if plain.isalpha() or not plain:
        return plain
    swapped = plain.translate(_SWAPS)
    return swapped if any(c.isalpha() for c in plain) else plain


FEATURES = ("direct", "addressed", "misspelled", "quoted", "densest", "share")


@dataclass
class Model:
    """``terms``: weight by term. ``weights``: of a constant and of each of FEATURES. ``exact``: terms that must be
    spelled right, because clean texts are full of their neighbours."""

    terms: dict[str, float]
    weights: list[float]
    exact: frozenset[str] = frozenset()


class Scorer:
    def __init__(self, model: Model):
        self.model, self.lexicon = model, FuzzyLexicon(model.terms, model.exact)
        self.known = Kept(self._look_up, _KEPT_WORDS)

    def _look_up(self, word: str):
        return self.lexicon.find(letters_of(word)) or ()

    def features(self, text: str) -> list[float]:
        words = text.split()
        found = list(map(self.known.__getitem__, words))
        direct = addressed = misspelled = quoted = densest = 0.0
        hits = [i for i, f in enumerate(found) if f]
        for at in hits:
            weight, edits, _ = found[at]
            around = words[max(0, at - WINDOW):at + WINDOW + 1]
            plain = [_EDGE.sub("", w.lower()) for w in around]
            inside = _in_quotes(words, at)
            reported = sum(w in REPORTING for w in plain)
            if inside or reported >= 2:
                quoted += weight
                continue
            if edits:
                misspelled += weight / edits
            else:
                direct += weight
            if any(w in ADDRESS for w in plain):
                addressed += weight
            densest = max(densest, weight)
        return [math.log1p(direct), math.log1p(addressed), math.log1p(misspelled), math.log1p(quoted), densest,
                math.sqrt(len(hits) / max(1, len(words)))]

    def score(self, text: str | None) -> float:
        values = np.array([1.0, *self.features(text or "")])
        return float(1 / (1 + math.exp(-max(-60.0, min(60.0, float(values @ np.array(self.model.weights)))))))


def _in_quotes(words: list[str], at: int) -> bool:
    """A quotation mark opens before the word, or at it, and one closes at it or after it, within the window."""
    before = any(w[0] in _QUOTES for w in words[max(0, at - WINDOW):at + 1])
    after = any(w.rstrip(".,;:!?)")[-1:] in _QUOTES and w.rstrip(".,;:!?)") for w in words[at:at + WINDOW + 1])
    return bool(before and after)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, text, toxic) of up to ``per_class`` labelled documents of each class, those of smallest id hash.

    Documents whose crc32(doc_id) is 0 modulo 5 are held out. Of several labels of a document the greatest counts.
    """
    known = pick(labels, doc_id="doc_id", toxic="toxic").filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * per_class rows, whatever the size of the tables.
    return stored(pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id"), "toxicity-sample")


def _terms_of(text: str) -> set[str]:
    words = {letters_of(w) for w in text.split()}
    words = {w for w in words if 3 <= len(w) <= 40 and w.isalpha()}
    return words | {w[:n] + "*" for w in words for n in _STEM_LENGTHS if len(w) > n}


def learn_terms(sample: DataFrame, most: int = MOST_TERMS) -> dict[str, float]:
    """Words and stems that toxic documents hold far more often, with their log odds.

    Counts of documents per term are summed by Spark; the terms that pass are few, at most ``most`` reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(column(batch, "text").to_pylist(), column(batch, "toxic").to_pylist(), strict=True):
                counts[toxic].update(_terms_of(text or ""))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
                 pa.array([counts[0][t] for t in terms], pa.int64())], names=["term", "toxic", "clean"])

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = map_batches(sample, run, "term string, toxic bigint, clean bigint").groupBy("term") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (good + 1))
    rows = counts.filter((F.col("toxic") >= max(4, bad // 250))).withColumn("odds", odds).filter("odds > 2.3") \
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), "term").limit(2 * most).collect()
    terms = {r["term"]: (r["odds"], r["toxic"]) for r in rows}
    kept = {}
    for term, (value, count) in terms.items():
        letters = term.rstrip("*")
        shorter = [letters[:n] + "*" for n in _STEM_LENGTHS if n < len(letters)]
        # A longer form of a kept stem says nothing new; a stem seen with one ending only is that word.
        if any(s in terms and terms[s][0] >= value - 0.7 and terms[s][1] > count for s in shorter):
            continue
        if term.endswith("*") and any(
                t.rstrip("*") != letters and t.startswith(letters) and n >= 0.9 * count and v >= value
                for t, (v, n) in terms.items()):
            continue
        kept[term] = value
        if len(kept) == most:
            break
    return kept


def crowded_terms(sample: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """Terms of which over one clean document in 1,500 of the sample holds a misspelling, by the automaton."""
    lexicon = FuzzyLexicon(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            for text in column(batch, "text").to_pylist():
                found = (lexicon.find(w) for w in {letters_of(w) for w in (text or "").split()})
                seen.update({f[2] for f in found if f and f[1]})
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             names=["term", "n"])

    clean = sample.filter("toxic = 0")
    limit = clean.count() / 1500
    rows = map_batches(clean.select("text"), run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") > limit).collect()  # at most a row per term
    return frozenset(r["term"] for r in rows)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn the lexicon, then the model over FEATURES, from a bounded sample of labelled documents.

    The sample holds both classes in like numbers; the constant is set right for their true shares afterwards. With
    one class or none, the model gives every document the share of toxic labels.
    """
    sample = training_sample(docs, labels, per_class)
    terms = learn_terms(sample)
    exact = crowded_terms(sample, terms)
    scorer = Scorer(Model(terms, [0.0] * (1 + len(FEATURES)), exact))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [scorer.features(t or "") for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "toxic"), pa.array(values, pa.list_(pa.float64()))],
                                             names=["toxic", "features"])

    rows = map_batches(sample.select(F.col("toxic").cast("int"), "text"), run, "toxic int, features array<double>").collect()
    shares = pick(labels, doc_id="doc_id", toxic="toxic").filter("doc_id is not null and toxic in (0, 1)") \
        .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0) \
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("all")).head()
    bad, total = shares["bad"] or 0, shares["all"] or 0
    prior = math.log((bad + 0.5) / (total - bad + 0.5))
    toxic = np.array([r["toxic"] for r in rows], dtype=float)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(terms, [prior, *[0.0] * len(FEATURES)], exact)
    matrix = np.array([[1.0, *r["features"]] for r in rows])
    weights = logistic(matrix, toxic)
    weights[0] += prior - math.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))
    return Model(terms, [float(w) for w in weights], exact)


#: What the weights of FEATURES are drawn towards: a sample may lack misspelled or quoted terms altogether.
_EXPECTED = (2.0, 0.3, 2.0, -0.5, 0.1, 0.0)


def logistic(matrix: np.ndarray, target: np.ndarray, ridge: float = 2.0, rounds: int = 50) -> np.ndarray:
    """Newton's method; every weight but the constant is drawn towards its expected value."""
    expected = np.array([0.0, *_EXPECTED])
    weights = np.zeros(matrix.shape[1])
    penalty = np.full(matrix.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(matrix @ weights, -30, 30)))
        gradient = matrix.T @ (p - target) + penalty * (weights - expected)
        hessian = (matrix * (p * (1 - p))[:, None]).T @ matrix + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row; other columns are not read. NULL and empty texts score as texts without a match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            values = [scorer.score(t) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(values, pa.float64())],
                                             names=["doc_id", "score"])

    texts = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(texts, run, "doc_id bigint, score double")


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay, whatever their names.

    A NULL text scores like an empty one, which has no term and so the score of the bare model. Texts of any length are
    read whole; repeated rows are judged each, and an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch], named: dict) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            keep = [scorer.score(t) < threshold for t in column(batch, named["text"]).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_whole_rows(docs, run, "text")
