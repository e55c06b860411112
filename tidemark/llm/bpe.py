"""BPE encoding and decoding, with merges picked from a segment tree.

A word's symbols sit in a row. Leaf ``i`` of a segment tree holds the merge rank of the pair that starts at symbol
``i``, joined with its position, so the minimum at the root is the leftmost pair of lowest rank. A merge changes
three leaves, each repaired on its way to the root: a word of n symbols takes O(n log n) however long it is.

Pieces depend on white-space-delimited words alone, so the codes of a word are kept in a bounded table per Python
worker and each batch only looks words up.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import Kept, column, map_batches, pick

#: Words, and pieces of words, whose codes a worker keeps.
KEPT_WORDS, KEPT_PIECES = 120_000, 240_000
_POSITIONS = 1 << 32
_NONE = 1 << 62
#: Python's str.split also splits at these, which Unicode does not class as white space.
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Fixed value: how the vocabulary splits words of Latin letters, in lower case, into pieces.
_LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:\W|_)+")
_LATIN = re.compile("[\0-ɏ]*")
_WHITE = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    names.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [names[b] for b in range(256)]


class Merges:
    """Merge table over token ids, which are below 2 ** 20."""

    def __init__(self, ranked: list[tuple[int, int, int]]):
        """``ranked``: (left, right, merged) in order of rank."""
        pairs = [(left << 20 | right, merged) for left, right, merged in ranked]
        self.merged = dict(pairs)
        self.ranks = {pair: rank * _POSITIONS for rank, (pair, _) in enumerate(pairs)}

    def apply(self, symbols: list[int]) -> list[int]:
        """Merge the leftmost pair of lowest rank until no pair can be merged."""
        count, rank_of, merged = len(symbols), self.ranks.get, self.merged
        if count < 2:
            return symbols
        width = 1 << (count - 2).bit_length()
        tree = [_NONE] * (2 * width)
        for i in range(count - 1):
            rank = rank_of(symbols[i] << 20 | symbols[i + 1])
            if rank is not None:
                tree[width + i] = rank + i
        for node in range(width - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after = list(range(1, count + 1))
        before = list(range(-1, count))
        while tree[1] < _NONE:
            at = tree[1] % _POSITIONS
            gone, previous = after[at], before[at]
            symbol = symbols[at] = merged[symbols[at] << 20 | symbols[gone]]
            symbols[gone] = -1
            following = after[at] = after[gone]
            before[following] = at
            changed = [(at, rank_of(symbol << 20 | symbols[following]) if following < count else None)]
            if gone < count - 1:
                changed.append((gone, None))
            if previous >= 0:
                changed.append((previous, rank_of(symbols[previous] << 20 | symbol)))
            for leaf, rank in changed:
                node = width + leaf
                tree[node] = _NONE if rank is None else rank + leaf
                while node > 1:
                    node >>= 1
                    left, right = tree[2 * node], tree[2 * node + 1]
                    if right < left:
                        left = right
                    if tree[node] == left:
                        break
                    tree[node] = left
        return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder for one vocabulary file with word ends."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        model = parsed["model"]
        vocabulary, self.end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = [""] * (1 + max([*vocabulary.values(), *(t["id"] for t in parsed["added_tokens"])]))
        for token, number in vocabulary.items():
            self.tokens[number] = token
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        for token, number in self.special.items():
            self.tokens[number] = token
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        names = byte_symbols()
        self.inner = [vocabulary[c] for c in names]
        self.last = [vocabulary[c + self.end] for c in names]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = Merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges])
        # Beyond Latin letters, the definition's own normaliser and splitter decide: Unicode tables differ between libraries.
        defined = Tokenizer.from_str(json.dumps(parsed | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normal, self.splitter = defined.normalizer, defined.pre_tokenizer[0]
        self.known_pieces = Kept(self.piece, KEPT_PIECES)
        self.known_words = Kept(self.word, KEPT_WORDS)

    def piece(self, text: str) -> bytes:
        """Codes of one piece, as little-endian unsigned 32-bit integers."""
        data = text.encode("utf-8", "surrogatepass")
        merged = self.merges.apply([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])
        return struct.pack(f"<{len(merged)}I", *merged)

    def word(self, text: str) -> bytes:
        """Codes of a text without white space."""
        if text.isascii() or _LATIN.fullmatch(text):
            pieces = _LATIN_PIECES.findall(text.lower())
        else:
            pieces = [p for p, _ in self.splitter.pre_tokenize_str(self.normal.normalize_str(text))]
        return b"".join(map(self.known_pieces.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Codes of a text; special tokens that occur in it get their own codes."""
        if not self.marks or not self.marks.search(text):
            return self._plain(text)
        parts = self.marks.split(text)
        return b"".join(struct.pack("<I", self.special[part]) if at % 2 else self._plain(part)
                        for at, part in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        words = [w for w in _WHITE.split(text) if w] if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.known_words.__getitem__, words))

    def decode(self, codes: bytes) -> str:
        """The tokens' strings, joined by spaces: the vocabulary comes without a decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(codes, "<u4").tolist()))


_codecs: dict[str, Codec] = {}


def codec(definition: str) -> Codec:
    """The codec of a definition, built once per Python worker."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(definition)
    return _codecs[key]


def transcode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and decode the codes again.

    ``vocabulary`` is the path of a tokenizers JSON file, read by the driver: BPE with an end-of-word suffix over
    bytes. Returns ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit integers) and ``decoded`` (the codes'
    tokens joined by spaces) for every row, repeated rows included. A NULL text counts as empty; an empty text has
    no codes and decodes to the empty text. Other columns are not read, whatever their names.
    """
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(definition)
        for batch in batches:
            ids = [coder.encode(t) if t else b"" for t in column(batch, "text").to_pylist()]
            decoded = [coder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"])

    texts = pick(docs, doc_id=doc_id, text=text)
    return map_batches(texts, run, f"doc_id {texts.schema[0].dataType.simpleString()}, ids binary, decoded string")


def digests(codes: DataFrame) -> DataFrame:
    """Row per document of ``transcode``: token count and SHA-256 of codes and decoded text."""
    return codes.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
