import hashlib
import struct

import public_tokenizers
import pytest
from frames import awkward_texts, documents, empty, result
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Codec(file.read())


def ids_of(codec, text):
    data = codec.encode(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@pytest.mark.parametrize("text", [t for t in awkward_texts() if t is not None])
def test_equals_library(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(codec, text) == ids
    assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_library_on_any_text(codec, library, text):
    assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_equals_library_on_latin_letters(codec, library):
    latin = [chr(i) for i in range(0x250)]
    for text in ["".join(latin), *(f"a{c}b'{c}{c}1_{c}" for c in latin), *(f"{c}:{d}" for c in latin[::7] for d in latin[::5])]:
        assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids, text


def test_merges_against_rescanning():
    """The tree gives what looking at all pairs before each merge gives."""
    ranked = [(1, 1, 3), (1, 2, 4), (3, 1, 5), (4, 4, 6), (2, 1, 7), (5, 2, 8)]
    table, pairs = bpe.Merges(ranked), {(a, b): (rank, c) for rank, (a, b, c) in enumerate(ranked)}

    def slow(symbols):
        while True:
            found = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
            if not found:
                return symbols
            _, i = min(found)
            symbols = symbols[:i] + [pairs[symbols[i], symbols[i + 1]][1]] + symbols[i + 2:]

    import itertools
    for length in range(1, 8):
        for symbols in itertools.product((1, 2), repeat=length):
            assert table.apply(list(symbols)) == slow(list(symbols))


def test_frames(spark, library):
    rows = bpe.transcode(documents(spark), PATH).collect()
    assert len(rows) == len(awkward_texts()) + 2
    for row, text in zip(sorted((r for r in rows if r.doc_id is not None), key=lambda r: r.doc_id), awkward_texts()):
        assert list(struct.unpack(f"<{len(row.ids) // 4}I", row.ids)) == library.encode(text or "", add_special_tokens=False).ids
    digest = {r.doc_id: r for r in bpe.digests(bpe.transcode(documents(spark), PATH)).collect()}
    assert digest[0].n_tokens == 0 and digest[0].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert result(bpe.transcode(documents(spark, clashing=True), PATH)) == result(bpe.transcode(documents(spark), PATH))
    assert bpe.transcode(empty(spark), PATH).count() == 0
