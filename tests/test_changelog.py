import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from logs import EDGES, EDGES_MIRROR, PEOPLE, edge_log, rows
from tidemark.operators import changelog as C, offsets as O
from tidemark.operators.envelope import bronze_table
from tidemark.operators.quality import same_rows

OPS = st.sampled_from(["r", "c", "u", "d"])
EVENTS = st.lists(st.tuples(OPS, st.integers(0, 4), st.integers(0, 6)), min_size=1, max_size=14)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def bronze_rows(spark, events):
    """Bronze rows from (op, key, ts_ms), the position being the offset."""
    data = []
    for offset, (op, key, ts_ms) in enumerate(events):
        before, after = (key, None) if op == "d" else (None, key)
        data.append((PEOPLE.topic, key % 2, offset, None, "people", op, ts_ms, None, after, before,
                     None if after is None else f"n{offset}", None, None))
    return spark.createDataFrame(data, PEOPLE.bronze_schema)


def brute_force(events):
    """Sequential replay in rank order."""
    state = {}
    for offset, (op, key, ts_ms) in sorted(enumerate(events), key=lambda e: (e[1][2], e[0])):
        state[key] = (op, f"n{offset}", ts_ms)
    return {(key, name, ts_ms) for key, (op, name, ts_ms) in state.items() if op != "d"}


def test_edges(spark):
    bronze = bronze_table(edge_log(spark), PEOPLE)
    assert rows(C.current_state(bronze, PEOPLE)) == EDGES_MIRROR
    assert {r.id for r in C.deleted_keys(bronze, PEOPLE).collect()} == {3, 9}
    assert C.resurrected(C.deleted_keys(bronze, PEOPLE), C.current_state(bronze, PEOPLE), PEOPLE).isEmpty()


def test_edges_in_slices(spark):
    slices = [EDGES[i:i + 4] for i in range(0, len(EDGES), 4)]
    random.Random(7).shuffle(slices)
    batches = [bronze_table(edge_log(spark, part), PEOPLE) for part in [*slices, slices[0]]]
    assert rows(C.live_rows(C.replay(batches, PEOPLE), PEOPLE)) == EDGES_MIRROR


def test_as_of(spark):
    bronze = bronze_table(edge_log(spark), PEOPLE)
    names = lambda df: {(r.id, r.name) for r in df.collect()}
    assert names(C.state_as_of(bronze, PEOPLE, 125)) == {(1, "Alice"), (2, "Bob3"), (3, "CarolLate")}
    assert names(C.state_as_of(bronze, PEOPLE, 8, by="offset")) == {(1, "Alice"), (2, "Bob3")}
    assert rows(C.state_as_of(bronze, PEOPLE, 10**9)) == EDGES_MIRROR
    saved = spark.createDataFrame([(PEOPLE.topic, 0, 8)], "topic string, kafka_partition int, next_offset long")
    assert names(C.state_as_of(bronze, PEOPLE, saved, by="offset")) == {(1, "Alice"), (2, "Bob3")}
    with pytest.raises(ValueError):
        C.state_as_of(bronze, PEOPLE, 1, by="moon")


def test_offset_order_and_counts(spark):
    bronze = bronze_table(edge_log(spark), PEOPLE)
    found = {(r.id, r.name) for r in C.apply_in_offset_order(bronze, PEOPLE).collect()}
    assert found == {(0, "Zero"), (1, "AliceLate"), (2, "Bob3"), (3, "CarolLate"), (4, "Dan2")}
    assert tuple(C.count_applied(bronze, PEOPLE).first()) == (14, 13)
    summary = O.run_summary(bronze, C.current_state(bronze, PEOPLE), PEOPLE).first()
    assert tuple(summary) == (14, 0, 15, 13, 4)


def test_missing_times_lose(spark):
    bronze = bronze_rows(spark, [("c", 1, 5), ("u", 1, None)])
    assert rows(C.current_state(bronze, PEOPLE)) == {(1, "n0", 5)}


@FEW
@given(events=EVENTS, seed=st.integers(0, 99))
def test_any_batching_gives_the_recomputed_state(spark, events, seed):
    bronze = bronze_rows(spark, events)
    order = random.Random(seed)
    batch_of = [order.randrange(3) for _ in events]
    batches = [bronze.filter(bronze.kafka_offset.isin([o for o, b in enumerate(batch_of) if b == n])) for n in range(3)]
    order.shuffle(batches)
    merged = C.live_rows(C.replay([*batches, batches[0]], PEOPLE), PEOPLE)
    assert rows(C.current_state(bronze, PEOPLE)) == brute_force(events)
    assert rows(merged) == brute_force(events)


@FEW
@given(old=EVENTS, new=EVENTS)
def test_applying_a_diff_gives_the_new_snapshot(spark, old, new):
    first, second = (C.current_state(bronze_rows(spark, e), PEOPLE).drop("updated_ts") for e in (old, new))
    diff = C.snapshot_diff(first, second, PEOPLE, ts_ms=1000)
    state = C.fold_state(bronze_rows(spark, old), PEOPLE)
    applied = C.live_rows(C.apply_changes(state, diff, PEOPLE), PEOPLE).drop("updated_ts")
    assert same_rows(applied, second)
    assert C.snapshot_diff(second, second, PEOPLE, ts_ms=1).isEmpty()


def test_pending(spark):
    log = edge_log(spark)
    stored = spark.createDataFrame([(PEOPLE.topic, 0, 9), ("gone", 3, 5)],
                                   "topic string, kafka_partition int, next_offset long")
    gate = O.pending(log, stored)
    assert rows(gate) == {(PEOPLE.topic, 0, 9, 15, 6), ("gone", 3, 5, 5, 0)}
    assert O.offset_ranges(gate.collect()) == ({(PEOPLE.topic, 0): 9}, {(PEOPLE.topic, 0): 15})
    assert rows(O.high_water(bronze_table(log, PEOPLE))) == {(PEOPLE.topic, 0, 15)}


def test_a_hot_key_sends_one_row_per_task(spark):
    """The events of a key are combined before the shuffle, whatever their number."""
    hot = spark.range(0, 200_000, 1, 8).selectExpr("1 AS id", "id AS ts_ms", "id AS kafka_offset", "0 AS kafka_partition")
    latest = C.latest_per_key(hot, "id")
    assert latest.first().ts_ms == 199_999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
