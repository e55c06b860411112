import json

import pytest

from logs import EDGES_MIRROR, PEOPLE, edge_log, envelope, log, message, rows
from tidemark.operators.changelog import current_state
from tidemark.operators.undeclared import field, flatten_variants, parse_variants, propose_spec


def orders(spark):
    bodies = [
        envelope("c", 1, after={"id": 1, "total": 12.5, "paid": True, "lines": [1, 2], "to": {"city": "X", "zip": 9}, "note": "a"}),
        envelope("u", 2, after={"id": 2, "total": 7, "paid": None, "to": {"city": None}, "note": 5}, wrapped=False),
        envelope("d", 3, before={"id": 1}, lsn=77), '{"op": "c"', "not json", "[1, 2]",
        json.dumps({"op": "c", "ts_ms": 4, "after": {"id": 12345678901234567890, "odd name": 1e300}})]
    return log(spark, [message(i, body, "orders") for i, body in enumerate(bodies)] + [message(9, None, "orders")])


def test_variants_keep_types(spark):
    parsed = parse_variants(orders(spark))
    got = {r.kafka_offset: r for r in parsed.select(
        "kafka_offset", "op", "ts_ms", "source_lsn", "is_corrupt", field("after", "total", "double").alias("total"),
        field("after", "paid", "boolean").alias("paid"), field("after", "to", "string").alias("to"),
        field("after", "note", "string").alias("note"), field("before", "id", "bigint").alias("gone"),
        field("after", "odd name", "double").alias("odd")).collect()}
    assert len(got) == 7 and {o for o, r in got.items() if r.is_corrupt} == {3, 4}
    assert (got[0].op, got[0].total, got[0].paid, json.loads(got[0].to)) == ("c", 12.5, True, {"city": "X", "zip": 9})
    assert (got[1].op, got[1].total, got[1].paid, got[1].note) == ("u", 7.0, None, "5")
    assert (got[2].op, got[2].ts_ms, got[2].source_lsn, got[2].gone) == ("d", 3, 77, 1)
    assert got[5].op is None and got[6].odd == 1e300


def test_proposed_declaration(spark):
    parsed = parse_variants(orders(spark))
    spec = propose_spec(parsed.filter("kafka_offset < 6"), "orders", "id")
    assert [(f.name, f.dataType.simpleString()) for f in spec.columns] == [
        ("id", "bigint"), ("lines", "string"), ("note", "string"), ("paid", "boolean"), ("to", "string"), ("total", "double")]
    assert propose_spec(parsed, "orders", "id").columns["id"].dataType.simpleString().startswith("decimal(")
    with pytest.raises(ValueError):
        propose_spec(parsed, "orders", "order_id")
    with pytest.raises(ValueError):
        propose_spec(parsed.limit(0), "orders", "id")
    live = current_state(flatten_variants(parsed.filter("kafka_offset < 6"), spec), spec).collect()
    assert [(r.id, r.total, r.note) for r in live] == [(2, 7.0, "5")]


def test_same_mirror_as_declared(spark):
    parsed = parse_variants(edge_log(spark))
    spec = propose_spec(parsed, "people", "id")
    assert spec.columns.names == PEOPLE.columns.names
    assert rows(current_state(flatten_variants(parsed, spec), spec)) == EDGES_MIRROR
