import random
from fractions import Fraction

import pytest
from frames import documents, empty, result

from tidemark.llm import mixing


@pytest.mark.parametrize("seed", range(20))
def test_less_than_one_block_off(seed):
    rng = random.Random(seed)
    slots = mixing.whole_slots({f"s{i}": rng.random() + 0.01 for i in range(rng.randint(1, 12))}, 256)
    assert sum(slots.values()) == 256
    placed = mixing.frame_schedule(slots, 256)
    assert sorted(at for own in placed.values() for at in own) == list(range(256))
    for source, own in placed.items():
        had = 0
        for slot in range(256):
            had += slot in own
            assert abs(had * 256 - (slot + 1) * slots[source]) < 256
        for block, at in enumerate(own):
            assert block * 256 // slots[source] <= at < -(-(block + 1) * 256 // slots[source])


def slow_order(blocks, weights, frame):
    """Slot by slot over all blocks, earliest deadline first, weights anew whenever a source runs out."""
    left, out = {s: n for s, n in blocks.items() if n}, []
    while left:
        slots = mixing.whole_slots({s: weights[s] for s in left}, frame)
        order, had, slot = sorted(slots, key=str), dict.fromkeys(slots, 0), 0
        while all(left.values()):
            ready = [(-(-(had[s] + 1) * frame // slots[s]), order.index(s)) for s in order if had[s] * frame // slots[s] <= slot]
            source = order[min(ready)[1]]
            out.append(source)
            had[source] += 1
            left[source] -= 1
            slot += 1
        left = {s: n for s, n in left.items() if n}
    return out


def test_phases_equal_simulation(spark):
    sources = {"a": 700, "b": 90, "c": 33, "d": 1}
    rows = [(i, s) for i, s in enumerate(s for s, n in sources.items() for _ in range(n))]
    frame = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 0.2, "b": 0.5, "c": 0.2, "d": 0.1}
    found = mixing.mix(frame, weights, block_rows=4, frame=64).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(rows)))
    assert all(r.released <= r.slot < r.deadline for r in found)
    by_slot = dict(sorted({r.slot: r.source for r in found}.items()))
    assert list(by_slot) == list(range(len(by_slot)))
    blocks = {f"={s}": -(-n // 4) for s, n in sources.items()}
    assert [f"={s}" for s in by_slot.values()] == slow_order(blocks, {f"={s}": w for s, w in weights.items()}, 64)
    assert len({r.position for r in found}) == len(found)


def test_given_weights_hold_over_many_frames(spark):
    sources = {f"src{i}": 400 + 50 * (i == 7) for i in range(20)} | {"src0": 900, "src1": 1350}
    rows = [(i, s) for i, s in enumerate(s for s, n in sources.items() for _ in range(n))]
    weights = {s: Fraction(3, 4) / 18 for s in sources} | {"src0": Fraction(1, 10), "src1": Fraction(3, 20)}
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"src0": 0.1, "src1": 0.15}, 1).collect()
    order = {r.slot: r for r in found}
    assert sorted(order) == list(range(len(rows)))
    had = dict.fromkeys(sources, 0)
    for slot in range(8000):
        row = order[slot]
        weight = weights[row.source]
        assert row.released == had[row.source] // weight and row.deadline == -(-(had[row.source] + 1) // weight)
        had[row.source] += 1
        assert all(abs(n - (slot + 1) * weights[s]) < 1 for s, n in had.items())


@pytest.mark.parametrize("sent", (0, 100_000))
def test_long_fractions_and_zero(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "_SENT_SLOTS", sent)
    frame = spark.range(900).selectExpr("id AS doc_id", "CAST(id % 3 AS string) AS source")
    weights = {"0": 0.6180339887498949, "1": 1e-300, "2": 0.0}
    found = {r.slot: r for r in mixing.mix(frame, weights, 1).collect()}
    assert sorted(found) == list(range(900)) and {r.doc_id for r in found.values()} == set(range(900))
    assert [found[i].source for i in range(600, 900)] == ["2"] * 300
    assert all(r.released <= r.slot < r.deadline for r in found.values())
    many = {str(i): 1 / 2000 for i in range(2000)}
    assert mixing.exact_slots(many) == (dict.fromkeys(many, 1), 2000)


def test_slices_number_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_NUMBERED_ROWS", 10)
    frame = spark.range(500).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'x' ELSE 'y' END AS source")
    rows = mixing.numbered(frame, "source", "doc_id").collect()
    for source in "xy":
        own = [r["at"] for r in rows if r.source == source]
        assert sorted(own) == list(range(len(own)))


def test_frames(spark):
    frame = documents(spark)
    rows = mixing.mix(frame, {"s0": 0.7}).collect()
    assert len(rows) == frame.count() and {r.source for r in rows} == {"s0", "s1", "s2", None}
    mixed = mixing.mixed(frame, {"s0": 0.7})
    assert mixed.columns == frame.columns and result(mixed) == result(frame)
    wide = documents(spark, clashing=True)
    assert mixing.mixed(wide).columns == wide.columns and result(mixing.mixed(wide)) == result(wide)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_order_of_rows(spark):
    frame = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 3 AS string) AS source")
    place = {r.doc_id: r.position for r in mixing.mix(frame, block_rows=4).collect()}
    order = [place[r.doc_id] for r in mixing.mixed(frame, block_rows=4).collect()]
    assert order == sorted(order)


def test_too_many_sources():
    with pytest.raises(ValueError):
        mixing.whole_slots({str(i): 1.0 for i in range(20)}, 10)
