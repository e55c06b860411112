import itertools
import math
import re

from frames import result

from tidemark.llm import queries, url_filter as U

URLS = [None, "", "no scheme", "://", "http://Example.COM/en/x?q=/fr/", "https://www.example.com/en/1", "http://example.com/EN/",
        "http://a.net/es/", "http://b.a.net/fr/x#y", "http://net/es/1", "http://anet/es/", "http://x.com", "http://x.com?a=/en/",
        "ftp://a://b/c", "http://cheap-pills.example.org/en/1", "http://quiet.example.org/en/2", "HTTP://casinowin.org",
        "http://user@h.org:80/p", "http://é.org/ü?x", "http://a.example.com/en/" + "y" * 5000, "x\nhttp://n.net/es/"]


def slow(url):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def pages(spark, urls=URLS):
    html = "<html><p>the quiet pill and the page, casino night: win</p><script>cheapest()</script></html>"
    rows = [(i, u, html if i % 2 else None) for i, u in enumerate(urls)]
    return spark.createDataFrame([*rows, rows[-1], (None, None, None)], "page_id long, url string, html string")


def test_rules_equal_brute_force(spark):
    for row in U.judge(pages(spark), queries.RULES).filter("page_id is not null").collect():
        host, path, rule, verdict = slow(URLS[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or ("block" if row.log_odds > U.BLOCK_ODDS else "allow"))
    verdicts = {URLS[r.page_id]: r.verdict for r in U.judge(pages(spark), queries.RULES).collect() if r.page_id is not None}
    assert verdicts["http://cheap-pills.example.org/en/1"] == "allow" and verdicts["HTTP://casinowin.org"] == "block"
    assert verdicts["http://quiet.example.org/en/2"] == "allow" and verdicts[None] == "allow"


def test_segments_are_the_likeliest():
    segmenter = U.Segmenter({"the": 50, "re": 20, "there": 3, "he": 9, "t": 2, "quiet": 5})
    for run in ("there", "therethe", "quietthere", "zzthezz", "t", "hehere"):
        splits = []
        for cuts in itertools.product((0, 1), repeat=len(run) - 1):
            marks = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(run)]
            splits.append([run[a:b] for a, b in itertools.pairwise(marks)])
        assert math.isclose(sum(map(segmenter.cost, segmenter.split(run))), min(sum(map(segmenter.cost, words)) for words in splits))
    assert U.runs_of("www.The-re.com", "/quiet1/x") == (["www", "the", "re"], ["quiet", "x"])


def counts_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


def test_segments_by_joins_equal_those_by_all_counts(spark):
    long = "x" * 70
    counts = {"the": 50, "re": 20, "there": 3, "he": 9, "t": 2, "quiet": 5, "é": 4, "ée": 7, long: 30, "xx": 3}
    texts = ["there", "therethe", "quietthere", "zzthezz", "t", "éeé", long, long + "the", "q" * 300, "a"]
    runs = spark.createDataFrame([(t,) for t in texts], "run string")
    got = {r.run: r.words for r in U.segmented(runs, counts_of(spark, counts)).collect()}
    assert got == {t: U.Segmenter(counts).split(t) for t in texts}
    assert got[long] == [long] and got["éeé"] == ["ée", "é"]


def test_a_rare_word_beyond_fifty_thousand_others_decides(spark):
    filler = {"".join("abcdefghij"[int(d)] for d in str(i)) + "zz": 3 for i in range(60_000)}
    counts = counts_of(spark, filler | {"quokka": 1, "grove": 1})
    urls = ["http://quokkagrove.net/es/1", "http://quokkabay.net/fr/2", "http://bay.net/es/", "http://quokkagrove.org/", "http://grove.com/"]
    for partitions in (1, 211):
        located = U.with_runs(spark.createDataFrame([(u, *slow(u)[:2], slow(u)[3]) for u in urls], "url string, host string, path string, ruled string")
                              .repartition(partitions))
        runs = U._runs(located).select("run").distinct()
        segments = U.segmented(runs, counts.unionByName(counts_of(spark, {"bay": 1})))
        assert {r.run: r.words for r in segments.collect()}["quokkagrove"] == ["quokka", "grove"]
        scores = {r.url: r.log_odds for r in U.scored(located, segments, U.learn(located, segments)).collect()}
        # Blocked hosts: 8 words, allowed ones: 1, different words: 5. quokka was blocked twice, grove once either way.
        shift = math.log((1 + 5 + 1) / (8 + 5 + 1))
        assert math.isclose(scores["http://quokkagrove.org/"], math.log(3) + 2 * shift, abs_tol=1e-8)
        assert math.isclose(scores["http://grove.com/"], shift, abs_tol=1e-8)
        without = U.segmented(runs, counts_of(spark, filler))
        assert {r.run: r.words for r in without.collect()}["quokkagrove"] == ["quokkagrove"]


def test_words_count_once_per_host(spark):
    located = U.with_runs(spark.createDataFrame(
        [("a.b.org", "/x", "block")] * 5 + [("c.b.org", "/x", "block"), ("a.d.org", "/x", "allow"), ("e.org", "/x", None)],
        "host string, path string, ruled string"))
    segments = U.segmented(U._runs(located).select("run").distinct(), counts_of(spark, {}))
    odds = {r.word: r.odds for r in U.learn(located, segments, listed=("b", "z")).collect()}
    seen = {"a": (1, 1), "b": (2 + U.LISTED, 0), "c": (1, 0), "d": (0, 1), "/x": (2, 1), "z": (U.LISTED, 0)}
    shift = math.log(3 + 5 + 1) - math.log(6 + 5 + 1)
    assert odds.keys() == seen.keys()
    assert all(math.isclose(odds[w], math.log((b + 1) / (a + 1)) + shift) for w, (b, a) in seen.items())


def test_ruled_urls_outweigh_the_list(spark):
    urls = [f"http://casino{i}.com/" for i in "abcdefgh"] + ["http://casino.org/", "http://poker.org/"]
    frame = spark.createDataFrame([(i, u, "casino poker a b c d e f g h") for i, u in enumerate(urls)], "page_id long, url string, html string")
    verdicts = {r.host: r.verdict for r in U.judge(frame, queries.RULES).collect()}
    assert verdicts["casino.org"] == "allow" and verdicts["poker.org"] == "block"


def test_frames(spark):
    wide = pages(spark).selectExpr("*", "1 AS URL", "2 AS rule", "3 AS host", "4 AS verdict", "5 AS ruled", "6 AS path")
    assert result(U.judge(wide, queries.RULES)) == result(U.judge(pages(spark), queries.RULES))
    assert U.judge(pages(spark).limit(0), queries.RULES).count() == 0
    assert {r.rule for r in U.judge(pages(spark), ()).collect()} == {None}
