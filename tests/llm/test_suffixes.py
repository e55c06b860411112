import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from frames import CLASHING, DOCUMENTS, awkward_texts, documents, empty, prose, result
from tidemark.llm import suffixes


def by_hand(rows, length):
    """doc_id, n_bytes, n_removed, n_spans, digest of (id, text) rows, window by window."""
    least = {}
    for i, t in rows:
        t = (t or "").encode()
        for at in range(len(t) - length + 1):
            if i is not None:
                w = t[at:at + length]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = np.zeros(len(t) + 1, bool)
        for at in range(len(t) - length + 1):
            if i is not None and least[t[at:at + length]] < i:
                gone[at:at + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCUMENTS)


def mixed_rows(seed, n=60):
    """Texts put together from shared passages, own prose, runs of one letter and text beyond ASCII."""
    rng = random.Random(seed)
    shared = [prose(100 + i, 30) for i in range(6)] + ["ab" * 60, "x" * 400, "é" * 90, "naïve İstanbul ΑΣ 漢字 " * 5]
    rows = []
    for i in rng.sample(range(1000), n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            passage = rng.choice(shared)
            cut = rng.randint(0, len(passage) // 2)
            parts.append(rng.choice([passage, passage[cut:], passage[:-cut or None], prose(i, 20)]))
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    return rows


@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_suffix_order(texts):
    codes, ends = [], []
    for t in texts:
        codes += [b + 1 for b in t] + [0]
        ends.append(len(codes) - 1)
    codes = np.array(codes, np.int16)
    left = np.array([min(e for e in ends if e >= i) - i for i in range(len(codes))])
    order = suffixes.suffix_order(codes, left, 20)
    assert sorted(order) == list(range(len(codes)))
    shown = [tuple(codes[i:i + min(left[i], 20)]) for i in order]
    assert shown == sorted(shown)
    common = suffixes.common_prefixes(codes, order, 20)
    for (a, b), n in zip(zip(order, order[1:]), common[1:]):
        full = next((k for k in range(20) if a + k >= len(codes) or b + k >= len(codes) or codes[a + k] != codes[b + k]), 20)
        assert (n >= 20) == (full >= 20) and n <= full


@pytest.mark.parametrize("length", [1, 7, 50])
def test_anchors_cover_all_windows(length):
    texts = [b"", b"a" * 300, prose(1, 90).encode(), b"short", ("é" * 40).encode()]
    seen = {}
    for data, row, offset, place, count, anchor in suffixes._found(texts, length):
        for r, lo, p, n, a in zip(row, offset, place, count, anchor):
            assert data[p:p + n + length - 1] == texts[r][lo:lo + n + length - 1]
            for k in range(n):
                assert seen.setdefault(texts[r][lo + k:lo + k + length], a) == a
    assert set(seen) == {t[i:i + length] for t in texts for i in range(len(t) - length + 1)}


def test_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(suffixes, "_SLICE", 100)
    test_anchors_cover_all_windows(50)


@pytest.mark.parametrize("shard_bytes, wide", [(1 << 24, 64), (2000, 64), (2000, 1)])
def test_equals_brute_force(spark, shard_bytes, wide):
    rows = mixed_rows(3)
    rows += [(7, rows[0][1]), (7, rows[1][1] + "other"), rows[2], rows[2]]  # an id of three texts, and repeated rows
    removed = suffixes.remove_repeats(frame(spark, rows), 50, shard_bytes=shard_bytes, wide=wide)
    assert result(suffixes.digest(removed)) == by_hand(rows, 50)


def test_short_windows(spark):
    rows = [(i, prose(i, 40)) for i in range(30)]
    assert result(suffixes.digest(suffixes.remove_repeats(frame(spark, rows), 6, shard_bytes=500))) == by_hand(rows, 6)


def test_awkward_tables(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    expected = by_hand(rows, 50)
    for clashing in (False, True):
        assert result(suffixes.digest(suffixes.remove_repeats(documents(spark, clashing=clashing)))) == expected
    assert len(rows) == len(awkward_texts()) + 2 and CLASHING
    assert suffixes.digest(suffixes.remove_repeats(empty(spark))).collect() == []


def test_spans_and_bytes(spark):
    passage = "this passage has more than fifty bytes and stands in both of the texts"
    got = {r.doc_id: r for r in suffixes.remove_repeats(frame(spark, [(2, f"own {passage} end"), (1, passage)])).collect()}
    assert got[1].spans == [] and bytes(got[1].kept) == passage.encode()
    assert [tuple(s) for s in got[2].spans] == [(4, 4 + len(passage))] and bytes(got[2].kept) == b"own  end"


def test_packed_numbers():
    for values in ([], [0], [7, 7, 1 << 39, (1 << 40) - 1], [(1 << 64) - 1]):
        assert suffixes.unpacked(suffixes.packed(np.array(values, np.uint64))).tolist() == values


def test_different_stretches():
    passage = prose(3, 60).encode()
    once, counts = suffixes.different_stretches([passage], 50)
    again, same = suffixes.different_stretches([passage] * 5, 50)
    assert once.tolist() == again.tolist() and counts.tolist() == same.tolist()
    known, many = suffixes.different_stretches([prose(i, 20).encode() + passage for i in range(9)], 50)
    assert set(once) <= set(known) and max(many) >= 9


def test_a_passage_of_every_shard_is_sent_whole(spark):
    passage = prose(1, 200)
    shards = spark.createDataFrame([(i, i, i, bytearray((prose(100 + i, 60) + passage).encode())) for i in range(200)],
                                   "shard int, id long, mark long, text binary")
    firsts = suffixes.first_of_texts(shards)
    anchors = suffixes.repeated_anchors(shards, firsts, 50, 200)
    sent = suffixes.repeated_stretches(shards, firsts, anchors, 50, 1600)
    moved = [len(s) for r in sent.select("stretch").collect() for s in r.stretch or ()]
    assert 200 * len(passage) < sum(moved) < 200 * 8 * len(passage)
