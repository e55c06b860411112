"""Language of words by a linear-chain conditional random field, and of documents by their words.

Words of a sentence are a chain of labels, one language each. A word's affixes, letter n-grams and, if it is frequent,
the word itself give it a score per language; learned transitions tie neighbours together, so that a foreign word or
a change of language inside a text comes out as such. Forward-backward gives each word's probabilities. A document's
language is the one with the greatest mean over its words.

Chains of a batch advance together, one word per step, in numpy; scores of a word are kept per Python worker.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, stored

#: Documents per language, of smallest hash, whose sentences are looked at for a sample.
SAMPLE_DOCS = 1000
#: Sentences per language, of smallest hash, from which a model is fitted.
SAMPLE_CHAINS = 1000
#: Words in a chain; a longer sentence goes on as another chain.
CHAIN = 64
UNKNOWN = "und"
_KEPT_WORDS = 500_000
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features(word: str) -> list[str]:
    """Affixes, letter n-grams and the word itself, each marked with its kind."""
    shown = f"^{word}$"
    found = [f"p{word[:2]}", f"p{word[:3]}", f"s{word[-2:]}", f"s{word[-3:]}"]
    found += [shown[i:i + 3] for i in range(len(shown) - 2)]
    if len(word) <= 12:
        found.append(f"w{word}")
    return found


@dataclass
class Model:
    """``weights``: features by languages, its last row for no feature; ``moves``: from language (row) to language."""

    languages: list[str]
    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray


def plain(word: str) -> str:
    """A word in lower case without its edges of digits and signs; empty if it has no letter."""
    if word.isalpha() or any(map(str.isalpha, word)):
        return _EDGE.sub("", word.lower())
    return ""


def sentences(text: str) -> list[list[str]]:
    """Chains of words: sentences and lines, cut at CHAIN words."""
    out, chain = [], []
    for line in text.split("\n"):
        for word in line.split():
            chain.append(word)
            if word[-1] in ".!?" or len(chain) == CHAIN:
                out.append(chain)
                chain = []
        if chain:
            out.append(chain)
            chain = []
    return out


def marginals(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains laid end to end.

    ``scores``: words by languages. Gives each word's probabilities, and the summed probabilities of moves. Chains
    are taken longest first, so those that still run at a step are the first ones.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    long = lengths[order]
    steps = int(long[0]) if len(long) else 0
    running = [int(np.searchsorted(-long, -step, side="left")) for step in range(steps)]
    potential = np.exp(scores - scores.max(axis=1, keepdims=True))
    jump = np.exp(moves - moves.max())
    forward = np.empty_like(potential)
    for step in range(steps):
        at = starts[:running[step]] + step
        value = potential[at] if step == 0 else potential[at] * (forward[at - 1] @ jump)
        forward[at] = value / value.sum(axis=1, keepdims=True)
    out = np.empty_like(potential)
    pairs = np.zeros_like(moves)
    behind = np.ones((len(long), moves.shape[0]))
    for step in range(steps - 1, -1, -1):
        count = running[step]
        at = starts[:count] + step
        posterior = forward[at] * behind[:count]
        out[at] = posterior / posterior.sum(axis=1, keepdims=True)
        if step:
            carried = potential[at] * behind[:count]
            joint_total = ((forward[at - 1] @ jump) * carried).sum(axis=1, keepdims=True)
            pairs += (forward[at - 1] / joint_total).T @ carried * jump
            following = carried @ jump.T
            behind[:count] = following / following.sum(axis=1, keepdims=True)
    return out, pairs


def least_hashes(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The ``most`` rows of least hash of ``key`` in each group, or all.

    A bound on the hash, set from the number of rows so that four times as many lie below it, leaves out the others
    before rows of a group meet in one task. Hashes are even, so fewer than ``most`` below it do not occur in practice;
    if they did, the sample would be smaller.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("of"))
    share = F.least(F.lit(1.0), F.lit(4.0 * most) / F.col("of"))
    # Hashes run from -2^63 to 2^63 - 1.
    low = rows.join(counts, group).filter(F.xxhash64(key).cast("double") <= F.lit(-2.0 ** 63) + F.lit(2.0 ** 64) * share).drop("of")
    ranked = low.withColumn("at", F.expr(f"row_number() over (partition by {group} order by xxhash64({key}), {key})"))
    return ranked.filter(F.col("at") <= most).drop("at")


def sample_chains(docs: DataFrame, per_language: int = SAMPLE_CHAINS, docs_per_language: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, words) of a bounded sample of sentences; documents whose crc32(doc_id) is 1 modulo 3 are held out."""
    known = pick(docs, doc_id="doc_id", lang="lang", text="text").filter("doc_id is not null and lang is not null and text is not null") \
        .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    # Ranks documents without their texts.
    chosen = least_hashes(known.select("doc_id", "lang"), "lang", "doc_id", docs_per_language) \
        .select("doc_id", F.col("lang").alias("language")).distinct()
    # At most docs_per_language rows for each language, whatever the size of the table.
    texts = known.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, language in zip(column(batch, "text").to_pylist(), column(batch, "language").to_pylist(), strict=True):
                chains = [[p for p in map(plain, s) if p] for s in sentences(text)]
                chains = [c for c in chains if c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(chains), pa.string()), pa.array(chains, pa.list_(pa.string()))],
                    names=["lang", "words"])

    chains = stored(map_batches(texts, run, "lang string, words array<string>"), "langid-chains")
    return least_hashes(chains, "lang", "words", per_language).select("lang", "words")


def fit(docs: DataFrame, rounds: int = 12, per_language: int = SAMPLE_CHAINS) -> Model:
    """Learn weights and transitions from a bounded sample of labelled sentences, by gradient ascent on the likelihood.

    Features seen in fewer than three words of the sample are left out. Without a labelled document, a model knows no
    language.
    """
    rows = stored(sample_chains(docs, per_language), "langid-sample").orderBy("lang", "words").collect()
    languages = sorted({r["lang"] for r in rows})
    words = [w for r in rows for w in r["words"]]
    types, codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True) if words else ([], [])
    found = [features(t) for t in types]
    counts = Counter()
    for fs, times in zip(found, np.bincount(codes).tolist() if words else [], strict=True):
        for f in fs:
            counts[f] += times
    kept = sorted(f for f, n in counts.items() if n >= 3)
    index = {f: i for i, f in enumerate(kept)}
    weights = np.zeros((len(index) + 1, len(languages)))
    moves = np.zeros((len(languages), len(languages)))
    if not words:
        return Model(languages, index, weights, moves)
    table = [[index[f] for f in fs if f in index] or [len(index)] for fs in found]
    sizes = np.array([len(t) for t in table])
    flat = np.concatenate([np.array(t) for t in table])
    owner = np.repeat(np.arange(len(table)), sizes)
    lengths = np.array([len(r["words"]) for r in rows])
    label = np.repeat(np.array([languages.index(r["lang"]) for r in rows]), lengths)
    truth = np.eye(len(languages))[label]
    seen_moves = np.diag(np.bincount(np.array([languages.index(r["lang"]) for r in rows]), weights=lengths - 1,
                                     minlength=len(languages)))
    heed, heed_moves = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    for _ in range(rounds):
        scores = np.stack([np.bincount(owner, weights=weights[flat, k], minlength=len(table)) for k in range(len(languages))], 1)
        given, pairs = marginals(scores[codes], moves, lengths)
        error = np.stack([np.bincount(codes, weights=(truth - given)[:, k], minlength=len(table))
                          for k in range(len(languages))], 1)
        slope = np.stack([np.bincount(flat, weights=error[owner, k], minlength=len(weights))
                          for k in range(len(languages))], 1) / len(words) - 1e-6 * weights
        heed += slope ** 2
        weights += 0.5 * slope / np.sqrt(heed)
        # Labelled documents seldom change language, other texts do: transitions are drawn towards none.
        slope = (seen_moves - pairs) / len(words) - 0.02 * moves
        heed_moves += slope ** 2
        moves += 0.2 * slope / np.sqrt(heed_moves)
    return Model(languages, index, weights, moves)


class _Codes(dict):
    """Codes of words; one that is missing is worked out, and kept unless it is very long."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> int:
        code = self.learn(word)
        if len(word) <= 64:
            self[word] = code
        return code


class Labeller:
    """Applies a model to texts; scores of words seen are kept, up to a bound.

    ``codes`` has twice the row of a word's scores, plus one if the word ends a sentence. Row 0 is for words without
    letters, which are in no chain.
    """

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes(self._learn)
        self.rows = {"": 0}
        self.scores = np.zeros((1, len(self.model.languages)))
        self.pending: list[list[int]] = []

    def _learn(self, word: str) -> int:
        shown = plain(word)
        row = self.rows.get(shown)
        if row is None:
            index = self.model.index
            known = [r for f in features(shown) if (r := index.get(f)) is not None]
            row = self.rows[shown] = len(self.rows)
            self.pending.append(known or [len(index)])
        return 2 * row + (word[-1] in ".!?")

    def _score_pending(self) -> None:
        """Scores of all words that were new, in one go."""
        if self.pending:
            sizes = np.array([len(p) for p in self.pending])
            flat = np.fromiter((r for p in self.pending for r in p), dtype=np.int64, count=int(sizes.sum()))
            sums = np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            self.scores = np.concatenate([self.scores, sums])
            self.pending = []

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words with letters of ``texts``, and how many of them each text has."""
        if len(self.codes) > _KEPT_WORDS:
            self._forget()
        look_up = self.codes.__getitem__
        codes: list[int] = []
        line_ends, text_ends = [], []
        for text in texts:
            for line in text.split("\n"):
                codes.extend(map(look_up, line.split()))
                line_ends.append(len(codes))
            text_ends.append(len(codes))
        self._score_pending()
        coded = np.array(codes, dtype=np.int64)
        breaks = np.zeros(len(coded) + 1, dtype=np.int64)  # how many chains end before a word
        breaks[1:] = coded & 1
        breaks[line_ends] = 1
        rows, sentence = coded >> 1, np.cumsum(breaks)[:-1]
        kept = rows > 0
        totals = np.concatenate([[0], np.cumsum(kept)])
        sizes = np.diff(totals[np.concatenate([[0], text_ends])])
        rows, sentence = rows[kept], sentence[kept]
        if not len(rows):
            return np.zeros((0, len(self.model.languages))), sizes
        first = np.flatnonzero(np.concatenate([[True], np.diff(sentence) != 0]))
        within = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        starts = np.flatnonzero(within % CHAIN == 0)
        given, _ = marginals(self.scores[rows], self.model.moves, np.diff(np.append(starts, len(rows))))
        return given, sizes

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, mean probability) of each text; ``und`` and 0 if it has no letter or the model no language."""
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        given, sizes = self.words([t or "" for t in texts])
        ends = np.cumsum(sizes)
        out = []
        for end, size in zip(ends, sizes, strict=True):
            if size:
                mean = given[end - size:end].mean(axis=0)
                best = int(mean.argmax())
                out.append((self.model.languages[best], min(1.0, float(mean[best]))))
            else:
                out.append((UNKNOWN, 0.0))
        return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``; only doc_id and text are read.

    ``und`` with score 0 is for NULL texts and those without a letter. Of languages with the same mean the first by
    name is taken. Texts of any length are labelled whole, in chains of bounded length. Repeated rows are labelled
    each, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            found = []
            texts = column(batch, "text").to_pylist()
            for at in range(0, len(texts), 128):
                found += labeller.languages(texts[at:at + 128])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    texts = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(texts, run, "doc_id bigint, lang_pred string, score double")
