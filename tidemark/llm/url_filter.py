"""URL filter: explicit rules first, then a naive Bayes model over words that hosts and paths are made of.

Names in hosts run words together. A unigram model finds the split of greatest probability by the Viterbi recursion;
its counts are those of the words in all pages. Multinomial naive Bayes then scores the words of host and path. It learns
from all the urls that rules decide, and starts from a few words that name unwanted hosts.

Counts of words and of the Bayes model stay in Spark, however many there are. What is split are the distinct runs of
letters of all hosts and paths: their substrings are joined with the counts, each run is split on its own, its words are
joined with the model, and urls get the sums of their runs.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, stored

#: Log odds above which a url is blocked: four to one.
BLOCK_ODDS = math.log(4)
#: Letters of the longest word that is looked for inside a run; a longer word is known where it is the whole run.
LONGEST = 64
#: Blocked hosts that a word of the list below counts for, beside those seen; as many allowed ones outweigh them.
LISTED = 8
# Substrings of a run that are told apart before they are sent, and substrings sent at once.
_TOLD, _SENT = 1 << 20, 1 << 16

# Words that name unwanted hosts.
UNWANTED = ("spam", "casino", "poker", "viagra", "cialis", "payday", "porn", "xxx", "warez", "lottery", "adserver",
            "jackpot", "malware", "phishing")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = re.compile(r"[^\W\d_]+")
_TAGS = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.DOTALL | re.IGNORECASE)


@dataclass(frozen=True)
class Rule:
    """A verdict (allow or block) for a host and its subdomains, below a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, NULL if none does. Of rules of one length the first counts."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def page_words(pages: DataFrame, text: str = "html") -> DataFrame:
    """(word, n): how often each word stands in the visible text of all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for page in column(batch, text).to_pylist():
                if page:
                    counts.update(_RUNS.findall(html.unescape(_TAGS.sub(" ", page)).lower()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "n"])

    return map_batches(pages.select(text), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Segmenter:
    """Splits a run of letters into the words of greatest probability.

    ``counts``: those of the run's substrings that are words; ``total``: of all words together. A word that is not known
    is the less likely the longer it is, so that letters stay together where no known words explain them.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = max(1, sum(counts.values()) if total is None else total)
        self.costs = {w: math.log(total) - math.log(n) for w, n in counts.items()}
        self.base = math.log(total)

    def cost(self, word: str) -> float:
        return self.costs.get(word, self.base + 2.3 * len(word))

    def split(self, run: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            starts = range(max(0, end - LONGEST), end)
            if end == len(run) > LONGEST:
                starts = [0, *starts] if run in self.costs else starts
            cost, start = min((best[s] + self.cost(run[s:end]), s) for s in starts)
            best.append(cost)
            back.append(start)
        words, end = [], len(run)
        while end:
            words.append(run[back[end]:end])
            end = back[end]
        return words[::-1]


def runs_of(host: str, path: str) -> tuple[list[str], list[str]]:
    """Runs of letters of a host, without its last part, and of a path."""
    parts = host.split(".")
    return [r for part in parts[:-1] or parts for r in _RUNS.findall(part.lower())], _RUNS.findall(path.lower())


def with_runs(located: DataFrame) -> DataFrame:
    """Adds the runs of ``host`` and ``path``, each as one text with spaces between: ``host_runs`` and ``path_runs``."""
    added = [F.lit(None).cast("string").alias(n) for n in ("host_runs", "path_runs")]
    schema = located.select("*", *added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs_of(h, p) for h, p in zip(column(batch, "host").to_pylist(), column(batch, "path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([" ".join(f[i]) for f in found], pa.string()) for i in (0, 1))],
                                             names=[*batch.schema.names, "host_runs", "path_runs"])

    return map_batches(located, run, schema)


def substrings(runs: DataFrame) -> DataFrame:
    """(run, word): the substrings of two letters or more up to the longest word, and each run itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, words = [], []

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(owners, pa.string()), pa.array(words, pa.string())], names=["run", "word"])
            owners.clear()
            words.clear()
            return out

        for batch in batches:
            for text in column(batch, "run").to_pylist():
                told = {text}
                owners.append(text)
                words.append(text)
                for start in range(len(text) - 1):
                    for end in range(start + 2, min(len(text), start + LONGEST) + 1):
                        word = text[start:end]
                        if word not in told:
                            if len(told) >= _TOLD:
                                told.clear()
                            told.add(word)
                            owners.append(text)
                            words.append(word)
                    if len(words) >= _SENT:
                        yield emit()
        yield emit()

    return map_batches(runs, run, "run string, word string")


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words) of distinct ``runs``, by the counts (word, n) of all words."""
    # Words of one letter are in nearly every run: they go along, at most one per letter that there is.
    single = {r.word: r.n for r in counts.filter(F.length("word") == 1).collect()}
    total = counts.agg(F.sum("n")).head()[0] or 0
    known = substrings(runs).join(counts, "word").groupBy("run").agg(F.collect_set(F.struct("word", "n")).alias("known"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, words in zip(column(batch, "run").to_pylist(), column(batch, "known").to_pylist(), strict=True):
                found.append(Segmenter(single | {w["word"]: w["n"] for w in words or ()}, total).split(text))
            yield pa.RecordBatch.from_arrays([column(batch, "run"), pa.array(found, pa.list_(pa.string()))], names=["run", "words"])

    return map_batches(runs.join(known, "run", "left").select("run", "known"), split, "run string, words array<string>")


def _runs(rows: DataFrame, *kept: str) -> DataFrame:
    """The given columns, ``mark`` (empty for a run of a host, a slash for one of a path) and ``run``, for every run."""
    sides = [rows.select(*kept, F.lit(mark).alias("mark"), F.explode(F.split(name, " ")).alias("run"))
             for name, mark in (("host_runs", ""), ("path_runs", "/"))]
    return sides[0].unionByName(sides[1]).filter("run <> ''")


def words_of_rules(rules: tuple[Rule, ...]) -> frozenset[str]:
    """Words that rules themselves test: they tell how urls were ruled, not what is there."""
    return frozenset(w for r in rules for w in [*_RUNS.findall(r.host), *("/" + p for p in _RUNS.findall(r.path.lower()))])


def learn(located: DataFrame, segments: DataFrame, left_out: frozenset[str] = frozenset(),
          listed: tuple[str, ...] = UNWANTED) -> DataFrame:
    """(word, odds): log odds of blocking of every word of a url that a rule decides, and of the listed words.

    ``located`` has host, ruled (allow, block or NULL) and the runs. A word counts once per host and verdict, so a host
    with many urls weighs no more than another; words of a path begin with a slash. Classes are alike beforehand.
    """
    ruled = _runs(located.filter("ruled is not null"), "host", "ruled").distinct()
    words = ruled.join(segments, "run").select("host", "ruled", "mark", F.explode("words").alias("word")) \
        .select("host", "ruled", F.concat("mark", "word").alias("word")).distinct()
    seen = words.filter(~F.col("word").isin(*left_out)) if left_out else words
    seen = seen.groupBy("word").agg(F.count_if(F.col("ruled") == "block").alias("blocked"),
                                    F.count_if(F.col("ruled") == "allow").alias("allowed"))
    seen = stored(seen, "ruled-words")
    totals = seen.agg(F.coalesce(F.sum("blocked"), F.lit(0)), F.coalesce(F.sum("allowed"), F.lit(0)), F.count("*")).head()
    shift = math.log(totals[1] + totals[2] + 1) - math.log(totals[0] + totals[2] + 1)
    spark = located.sparkSession
    extra = spark.createDataFrame([(w, LISTED, 0) for w in listed], "word string, blocked bigint, allowed bigint")
    both = seen.unionByName(extra).groupBy("word").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    return both.select("word", (F.log(F.col("b") + 1.0) - F.log(F.col("a") + 1.0) + F.lit(shift)).alias("odds"))


def scored(located: DataFrame, segments: DataFrame, model: DataFrame) -> DataFrame:
    """``located`` with ``log_odds`` of blocking; words that the model does not have say nothing.

    Sums are made per distinct set of runs, not per url, and rounded, so that their order does not show.
    """
    keys = [located.select(F.lit(mark).alias("mark"), F.col(name).alias("key")).distinct() for name, mark in (("host_runs", ""), ("path_runs", "/"))]
    keys = keys[0].unionByName(keys[1]).filter("key <> ''")
    parts = keys.select("mark", "key", F.explode(F.split("key", " ")).alias("run"))
    odds = parts.select("mark", "run").distinct().join(segments, "run") \
        .select("mark", "run", F.explode("words").alias("word")) \
        .select("mark", "run", F.concat("mark", "word").alias("word")).join(model, "word") \
        .groupBy("mark", "run").agg(F.sum("odds").alias("odds"))
    sums = stored(parts.join(odds, ["mark", "run"]).groupBy("mark", "key").agg(F.sum("odds").alias("odds")), "odds")
    host, path = (sums.filter(F.col("mark") == mark).select(F.col("key").alias(name), F.col("odds").alias(f"{name}_odds"))
                  for name, mark in (("host_runs", ""), ("path_runs", "/")))
    zero = F.lit(0.0)
    return located.join(host, "host_runs", "left").join(path, "path_runs", "left").withColumn(
        "log_odds", F.round(F.coalesce("host_runs_odds", zero) + F.coalesce("path_runs_odds", zero), 9))


def judge(pages: DataFrame, rules: tuple[Rule, ...], page_id: str = "page_id", url: str = "url",
          text: str = "html", least_odds: float = BLOCK_ODDS) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict (allow or block) and log_odds of blocking.

    The longest rule that fits decides; else the model blocks what has log odds above ``least_odds``. A NULL url, and one
    without ://, has an empty host and path, fits no rule, and is allowed as there is nothing to score. NULL, empty and
    very long pages count with the words they have. Repeated rows are judged each; other columns are not read, and an
    empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    pages = pick(pages, page_id=page_id, url=url, html=text)
    located = pages.select("page_id", host.alias("host"), path.alias("path")) \
        .withColumn("rule", matched(rules, F.col("host"), F.col("path"), lambda r: r.text)) \
        .withColumn("ruled", matched(rules, F.col("host"), F.col("path"), lambda r: r.verdict))
    located = stored(with_runs(located), "located")
    counts = stored(page_words(pages), "words")
    runs = stored(_runs(located).select("run").distinct(), "runs")
    segments = stored(segmented(runs, counts), "segments")
    model = learn(located, segments, words_of_rules(rules))
    verdict = F.coalesce("ruled", F.when(F.col("log_odds") > least_odds, "block").otherwise("allow"))
    return scored(located, segments, model).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "log_odds")
