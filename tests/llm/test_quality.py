import random
import re

from frames import awkward_texts, documents, empty, prose, result

from tidemark.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


def random_texts():
    rng = random.Random(8)
    words = ["a", "b", "the", "#x", "é|", "\n", "\n\n", "\t", "\x0b", "\x1c", "\x85", "… ", "-"]
    return [" ".join(rng.choice(words[: rng.randint(2, 13)]) for _ in range(rng.randint(0, 90))) for _ in range(150)]


def test_counts(spark):
    texts = [t for t in awkward_texts() if len(t or "") < 20_000] + random_texts()
    frame = documents(spark, texts)
    rows = quality.judge(frame).filter("doc_id is not null").collect()
    for row in rows:
        expected = slow(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])


def test_verdicts(spark):
    clean = "The word of the day is here and it is that. " + prose(3, 70)
    texts = [clean, " ".join(f"wx{'yz' * (i % 4)}{i}" for i in range(70)), "# " * 40 + clean, "\n".join([prose(9, 6) + " the of"] * 8 + [clean]), clean.replace(" ", " 1234567890 "), None]
    rows = {r.doc_id: r for r in quality.judge(documents(spark, texts)).collect() if r.doc_id is not None}
    assert rows[0].kept and rows[0].broken == []
    assert rows[1].broken == ["stop_words"] and not rows[1].kept and not rows[1].base_failed
    assert "symbols_per_word" in rows[2].broken and "repeated_lines" in rows[3].broken and "words_with_letter" in rows[4].broken
    assert rows[5].broken == ["words"] and rows[5].base_failed and not rows[5].kept


def test_long_text_and_frames(spark):
    frame = documents(spark)
    rows = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert rows[7].n_words == 20_000 and len(rows) == frame.select("doc_id").distinct().count()
    wide = documents(spark, clashing=True)
    assert result(quality.judge(wide)) == result(quality.judge(frame))
    assert quality.judge(empty(spark)).count() == 0
    own = (quality.Rule("short", "n_words", 3, None),)
    assert {r.doc_id for r in quality.judge(frame, own).collect() if r.broken == ["short"] and r.doc_id is not None} == {3, 4, 8, 10, 12}


def test_no_python(spark):
    plan = quality.judge(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
