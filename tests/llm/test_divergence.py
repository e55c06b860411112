import random
import re
from collections import Counter, defaultdict

import pytest

from frames import CLASHING, DOCUMENTS, documents, empty, result
from tidemark.llm import divergence


def by_hand(rows, least_docs, top):
    groups, holders, counts = defaultdict(set), Counter(), Counter()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups[lang].add(source)
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        counts.update((lang, source, t) for t in terms)
        holders.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for (l, t), n in holders.items() if l == lang and n >= least_docs]
        have = {s: [counts[lang, s, t] for t in kept] for s in sources}

        def shares(found):
            return [1 + 1_000_000_000 * (c + 5) // (sum(found) + 5 * len(kept)) for c in found]

        p, q = {s: shares(c) for s, c in have.items()}, shares([sum(c) for c in zip(*have.values())])
        for s in sources:
            pairs = [(sum(abs(a - b) for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            terms = [(a - b, t) for a, b, c, t in zip(p[s], q, have[s], kept) if c and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(map(repr, out))


def rows_of(seed, n, sources=6):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "éclair", "ÀB", "x_y", "don't", "漢字", "zeta9eta", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = []
    for i in range(n):
        source = f"s{min(rng.randrange(sources), rng.randrange(sources))}"  # some sources are much larger
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 25))), rng.choice(["en", "de", None]), rng.choice([source, source, None])))
    return rows + [("alone", "xx", "s1"), (None, "yy", "s1"), ("", "yy", "s2"), ("a\x00b", "en", "empty"), *rows[:3]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, l, s, None) for i, (t, l, s) in enumerate(rows)], DOCUMENTS)


@pytest.mark.parametrize("least, top, n", [(1, 3, 60), (5, 50, 300), (30, 50, 300)])
def test_equals_brute_force(spark, least, top, n):
    rows = rows_of(n, n)
    assert result(divergence.audit(frame(spark, rows), least, top)) == by_hand(rows, least, top)


def test_many_sources_in_pieces(spark, monkeypatch):
    rows = [(f"a{'bcdefghij'[i % 9]} common", "en", f"s{i % 70}") for i in range(400)]
    monkeypatch.setattr(divergence, "_CELLS", 50)
    monkeypatch.setattr(divergence, "_ENTRIES", 5)
    assert result(divergence.audit(frame(spark, rows), 2)) == by_hand(rows, 2, 50)


def test_long_text_in_slices(monkeypatch):
    text = ("Word \x00" + "é" * 30 + " ") * 200 + "z" * 500
    whole = [t for part in divergence.terms_of(text.encode()) for t in part]
    monkeypatch.setattr(divergence, "_SLICE", 64)
    assert [t for part in divergence.terms_of(text.encode()) for t in part] == whole
    assert whole == [t.encode() for t in re.findall(r"[a-zé]+", text.lower())]


def test_shares_beyond_a_long(spark):
    row = spark.sql("SELECT 4000000000000L AS c, 9000000000000L AS n, 3L AS v") \
        .select(divergence.share("c", "n", "v").alias("p")).head()
    assert row.p == 1 + 10 ** 9 * (4 * 10 ** 12 + 5) // (9 * 10 ** 12 + 15)


def test_awkward_tables(spark):
    rows = [(r.text, r.lang, r.source) for r in documents(spark).collect()]
    for clashing in (False, True):
        assert result(divergence.audit(documents(spark, clashing=clashing), 2)) == by_hand(rows, 2, 50)
    assert CLASHING and divergence.audit(empty(spark)).collect() == []
