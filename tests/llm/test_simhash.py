import random

import xxhash
from frames import documents, empty, prose, result

from tidemark.llm import simhash
from tidemark.llm.graph import components


def slow_fingerprint(text, size):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)]
    return sum(1 << i for i in bits)


def slow_components(prints, distance):
    best = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= distance and best[a] < best[b]:
                    best[b], changed = best[a], True
    return best


def test_fingerprints(spark):
    frame = documents(spark)
    for row in simhash.fingerprints(frame).join(frame.select("doc_id", "text"), "doc_id").collect():
        assert row.fingerprint & (1 << 64) - 1 == slow_fingerprint(row.text, 3)


def test_pairs_lose_none(spark):
    rng = random.Random(3)
    for distance in (1, 2, 3):
        centres = [rng.getrandbits(64) for _ in range(12)]
        values = {c for c in centres}
        for c in centres:
            for _ in range(40):
                flips = rng.sample(range(64), rng.randint(1, 4))
                values.add(c ^ sum(1 << f for f in flips))
        rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(sorted(values))]
        found = simhash.close_pairs(spark.createDataFrame(rows, "id long, fingerprint long"), distance)
        expected = {(a, b) for a, x in rows for b, y in rows if a < b and ((x ^ y) & (1 << 64) - 1).bit_count() <= distance}
        assert {tuple(r) for r in found.collect()} == expected and expected


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 6), (6, 8), (None, 3), (2, 1)] + [(i, i + 1) for i in range(100, 160)]
    found = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (8, 6)} | {(i, 100) for i in range(100, 161)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    base = prose(5, 400)
    texts = [base, base + " tail", prose(6, 300), base, None, "", base.upper(), prose(6, 300) + " x y"]
    frame = documents(spark, texts)
    rows = simhash.near_duplicates(frame).collect()
    assert len(rows) == frame.count()
    prints = [(i, slow_fingerprint(t, 3)) for i, t in enumerate(texts)]
    expected = slow_components(prints, 2)
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id is not None} == set(expected.items())
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    kept = {r.doc_id for r in simhash.keep_one(frame).collect()}
    assert kept == {i for i, c in expected.items() if i == c} | {None}


def test_other_columns_and_empty(spark):
    plain, wide = documents(spark), documents(spark, clashing=True)
    assert result(simhash.near_duplicates(plain)) == result(simhash.near_duplicates(wide))
    kept = simhash.keep_one(wide)
    assert kept.columns == wide.columns and kept.count() == simhash.keep_one(plain).count()
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_hexadecimal(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(-1,), (255,)], "x long").select(simhash.hexadecimal(F.col("x"))).collect()
    assert [r[0] for r in rows] == ["f" * 16, "0" * 14 + "ff"]


def test_exploded_rows_are_not_broadcast(spark):
    nodes = simhash.stored(spark.range(2000).selectExpr("id", "xxhash64(id) AS fingerprint"), "nodes")
    pairs = simhash.close_pairs(nodes, 2)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    pairs.collect()
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
