"""Secret scans: patterns of known secrets, and random-looking strings by sliding-window entropy.

Candidate strings are long runs of characters that keys are made of. A window slides over each; its character counts
change by one in and one out per step, and so does the sum that gives the Shannon entropy. The threshold depends on
the character class of the candidate, because a class with few characters cannot reach a high entropy. Candidates on
the allow list are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, map_whole_rows, pick, replace_column

# The patterns of the base kinds, in the order in which kinds are listed.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")
# Words as paths, names and compounds have them: of one case, or in camel case, each shorter than a window. No two
# branches match the same text, so a match takes linear time.
_WORD = r"(?:(?:[A-Z]{1,19}|[A-Z]?[a-z]{1,19}|[A-Z]?[a-z]{1,15}(?:[A-Z][a-z]{1,15})+)(?![A-Za-z]))"

SPANS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class EntropyRule:
    """Which candidates look random.

    ``window``: characters in the sliding window, and the least length of a candidate. ``thresholds``: bits per character
    at which a window counts, by class. Letters of both cases reach their threshold when 15 characters of a window of 20
    differ; those of one case need 16, as some long compound words have 15. Digits alone are not judged: they cannot
    reach theirs, as long numbers look no other than keys (32 digits and more are of kind hex).
    ``allowed``: patterns of harmless candidates, matched against the whole candidate.
    """

    window: int = 20
    thresholds: dict = field(default_factory=lambda: {"digits": 3.4, "hex": 3.0, "letters": 3.75, "one case": 3.9,
                                                             "mixed": 3.6})
    allowed: tuple[str, ...] = (
        r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
        r".*EXAMPLE.*", rf"[-_/=+]*{_WORD}(?:[-_/=+]+{_WORD})*[-_/=+]*", r"sha(?:1|256|384|512)-.*",
    )


def character_class(text: str) -> str:
    """digits, hex (of one case, with a digit), one case (no digit; a capital may lead), letters (no digit) or mixed."""
    if text.isdigit():
        return "digits"
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) and re.search("[0-9]", text):
        return "hex"
    if re.search("[0-9]", text):
        return "mixed"
    return "one case" if text[1:].islower() or text.isupper() else "letters"


def random_stretches(text: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """Unions of the windows whose entropy reaches the threshold.

    The entropy of n characters with counts c is log2(n) - sum(c * log2(c)) / n; only two counts change per step.
    """
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, found = 0.0, []
    most = (math.log2(window) - threshold) * window + 1e-9
    for at, char in enumerate(text):
        count = counts.get(char, 0)
        if at >= window:
            old = text[at - window]
            before = counts[old]
            counts[old] = before - 1
            total += weight[before - 1] - weight[before]
            count = counts.get(char, 0)
        counts[char] = count + 1
        total += weight[count + 1] - weight[count]
        start = at - window + 1
        if start >= 0 and total <= most:
            if found and found[-1][1] >= start:
                found[-1] = (found[-1][0], at + 1)
            else:
                found.append((start, at + 1))
    return found


class Scanner:
    def __init__(self, rule: EntropyRule):
        self.rule = rule
        self.candidates = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % rule.window)
        self.allowed = re.compile("|".join(f"(?:{p})" for p in rule.allowed)) if rule.allowed else None

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then kind, in code points with the end excluded."""
        found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
        base = list(found)
        for m in self.candidates.finditer(text):
            value = m[0]
            if self.allowed and self.allowed.fullmatch(value):
                continue
            threshold = self.rule.thresholds[character_class(value)]
            for start, end in random_stretches(value, self.rule.window, threshold):
                start, end = start + m.start(), end + m.start()
                if not any(s <= start and end <= e for _, s, e in base):
                    found.append(("entropy", start, end))
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones together, replaced by ``[KIND]`` of the first."""
    out, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, rule: EntropyRule = EntropyRule(), doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Spans of secrets in whole texts: ``doc_id`` and ``spans`` (kind, start, end), a row per input row.

    The base kinds are found leftmost and without overlap per kind; a match that is too short is dropped with the
    text it covers. Spans of kind entropy are added unless a base span holds them. A NULL or empty text has no
    spans; repeated rows each get theirs. Other columns are not read, whatever their names.
    """
    scanner = Scanner(rule)
    texts = pick(docs, doc_id=doc_id, text=text)
    kind = texts.schema[0].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scanner.spans(t or "")]
                     for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(spans, spans_type)],
                                             names=["doc_id", "spans"])

    return map_batches(texts, run, f"doc_id {kind}, spans {SPANS}")


def redact(docs: DataFrame, rule: EntropyRule = EntropyRule(), text: str = "text",
           length: str | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind; all rows and columns stay.

    ``length`` names a column that holds the text's length in code points, set anew for texts that changed. A NULL
    text stays NULL.
    """
    scanner = Scanner(rule)

    def run(batches: Iterator[pa.RecordBatch], named: dict) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = column(batch, named[text])
            after = [redacted(t, s) if t and (s := scanner.spans(t)) else t for t in before.to_pylist()]
            values = pa.array(after, before.type)
            if length is not None:
                kept = column(batch, named[length])
                changed = pc.fill_null(pc.not_equal(values, before), False)
                lengths = pc.cast(pc.utf8_length(values), kept.type)
                batch = replace_column(batch, named[length], pc.if_else(changed, lengths, kept))
            yield replace_column(batch, named[text], values)

    return map_whole_rows(docs, run, text, *([] if length is None else [length]))


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``find_secrets``: counts by base kind, SHA-256 of the base spans, and all spans as text."""
    spans = F.col("spans")

    def many(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    def joined(which):
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", many("assign").alias("n_assign"), many("access").alias("n_access"),
                        many("hex").alias("n_hex"), many("entropy").alias("n_entropy"),
                        F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
                        joined(spans).alias("spans"))
