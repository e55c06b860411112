"""Quality rules as one projection: a table of thresholds over length, symbol, stop-word and line ratios.

Everything is built-in functions. Word windows that repeat are counted without leaving the row: their hashes tell whether
any repeats at all; only then are the windows sorted, so that equal ones are neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick

# White space between words, symbols, and frequent words of four languages.
_WHITE = r"[\x20\x09-\x0D]+"
_WHITE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "der", "die", "und", "das", "ein", "ist", "den", "le", "la",
              "les", "de", "et", "des", "que", "el", "los", "las", "en", "un", "y", "es")


@dataclass(frozen=True)
class Rule:
    """A measure, by name or as an SQL expression over the counts, must lie between ``least`` and ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The rules of the method. Counts that a ratio is taken of are never zero where base rules pass.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("words_with_letter", "n_letter_words / n_words", 0.7, None),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("cut_off_lines", "n_ellipsis_lines / n_lines", None, 0.3),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three which occurs twice or more."""
    last = F.size(words) - 3
    windows = F.sequence(F.lit(0), last)
    hashes = F.transform(windows, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    ordered = F.sort_array(F.transform(windows, lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("window"), i.alias("at"))))
    return F.when(last < 1, F.lit(0)).when(F.size(F.array_distinct(hashes)) == last + 1, F.lit(0)) \
        .otherwise(_covered(ordered, last))


def _covered(ordered: Column, last: Column) -> Column:
    neighbours = F.zip_with(F.slice(ordered, F.lit(1), last), F.slice(ordered, F.lit(2), last), lambda a, b: F.when(
        a["window"] == b["window"], F.array(a["at"], b["at"])))
    starts = F.array_distinct(F.flatten(F.filter(neighbours, lambda pair: pair.isNotNull())))
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts that rules may use, per row; other columns are not read.

    A NULL text has no words and counts as empty.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    inner = F.trim(whole, F.lit(_WHITE_CHARS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _WHITE))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.trim(line, F.lit(_WHITE_CHARS)) != "")
    split = pick(docs, doc_id=doc_id, text=text).select("doc_id", whole.alias("whole"), words.alias("words"), lines.alias("lines"))
    word, line = F.col("words"), F.col("lines")
    length = F.length("whole")

    def longs(value: Column, name: str) -> Column:
        return value.cast("long").alias(name)

    without = [F.translate("whole", characters, "") for characters in (_WHITE_CHARS, SYMBOLS)]
    stop = F.filter(word, lambda w: F.lower(w).isin(*STOP_WORDS))
    return split.select(
        "doc_id", longs(F.size(word), "n_words"), longs(F.length(without[0]), "word_chars"),
        longs(length - F.length(without[1]), "n_symbols"),
        longs(F.size(line) - F.size(F.array_distinct(line)), "n_dup_lines"),
        longs(_repeat_words(word), "n_repeat_words"), longs(F.size(line), "n_lines"),
        longs(F.size(stop), "n_stop_words"),
        longs(F.size(F.filter(word, lambda w: w.rlike(r"\p{L}"))), "n_letter_words"),
        longs(F.size(F.filter(line, lambda x: x.rlike(r"^[\x20\x09]*[-*•‣◦]"))), "n_bullet_lines"),
        longs(F.size(F.filter(line, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))), "n_ellipsis_lines"))


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that a row breaks, as one expression; a measure that is NULL breaks its rule."""
    broken = []
    for rule in rules:
        value = F.expr(rule.measure)
        fits = value.isNotNull()
        if rule.least is not None:
            fits = fits & (value >= rule.least)
        if rule.most is not None:
            fits = fits & (value <= rule.most)
        broken.append(F.when(fits, F.lit(None)).otherwise(F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, counts, base_failed, broken (names of broken rules) and kept.

    Base: fewer than 50 words, or over half of the words in repeated windows. A text without words fails it; its
    ratios are NULL. Texts of any length are judged whole, NULL as a text without words. Repeated rows are judged each;
    other columns play no part, and an empty table gives an empty result.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counts(docs, doc_id, text).withColumn("base_failed", base) \
        .withColumn("broken", F.when(F.col("n_words") == 0, F.array(F.lit("words"))).otherwise(compile_rules(rules)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
