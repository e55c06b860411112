import json

import pytest
from pyspark.sql import functions as F, types as T

import logs
from logs import PEOPLE, envelope, log, message, rows
from tidemark.operators import envelope as E
from tidemark.operators.changelog import current_state
from tidemark.schemas import CUSTOMERS, DRIVERS, with_created_at
from tidemark.sinks.messages import to_envelope
from tidemark.sources import event_log as L


def test_wrapped_and_bare_envelopes_read_alike(spark):
    after = {"id": 5, "name": "Eve"}
    df = log(spark, [message(0, envelope("c", 7, after=after, lsn=9)),
                     message(1, envelope("c", 7, after=after, lsn=9, wrapped=False))])
    bronze = E.bronze_table(df, PEOPLE)
    assert bronze.schema.names == PEOPLE.bronze_schema.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in PEOPLE.bronze_schema]
    found = [(r.op, r.ts_ms, r.source_lsn, r.after_id, r.after_name, r.before_id) for r in bronze.collect()]
    assert found == [("c", 7, 9, 5, "Eve", None)] * 2


def test_tombstones_go_and_tables_are_routed(spark):
    df = log(spark, [message(0, envelope("c", 1, after={"id": 1}), "customers"), message(1, None, "customers"),
                     message(0, envelope("c", 1, after={"id": 2}), "drivers"), message(0, "{}", "other")])
    routed = E.route(df, [CUSTOMERS, DRIVERS])
    assert {name: frame.count() for name, frame in routed.items()} == {"customers": 1, "drivers": 1}
    assert rows(E.count_by_table(L.read_event_log(df, [CUSTOMERS, DRIVERS]))) == {("customers", 1), ("drivers", 1)}
    assert L.read_topic(df, CUSTOMERS.topic).count() == 2


@pytest.mark.parametrize("rating, expected", [
    (4.85, 4.85), ("4.85", 4.85), ("AeU=", 4.85), ("/w==", -0.01), ("AA==", 0.0), ("?", None), (None, None)])
def test_decimal_forms(spark, rating, expected):
    after = {"id": 1, "rating": rating, "active": True}
    bronze = E.bronze_table(log(spark, [message(0, envelope("c", 1, after=after), "drivers")]), DRIVERS)
    assert bronze.first().after_rating == expected
    assert bronze.first().after_active is True


def test_micros_column(spark):
    spec = with_created_at(CUSTOMERS)
    after = {"id": 13, "name": "Eva", "created_at": 1777814684450968}
    bronze = E.bronze_table(log(spark, [message(0, envelope("c", 1, after=after), "customers")]), spec)
    micros = bronze.selectExpr("unix_micros(after_created_at)").first()[0]
    assert micros == 1777814684450968


def test_one_bad_value_only_loses_itself(spark):
    df = log(spark, [message(0, envelope("c", 1, after={"id": "x", "name": "kept"})),
                     message(1, envelope("c", "later", after={"id": "7", "name": "text id"}))])
    found = [(r.after_id, r.after_name, r.ts_ms) for r in E.bronze_table(df, PEOPLE).orderBy("kafka_offset").collect()]
    assert found == [(None, "kept", 1), (7, "text id", None)]


def test_quarantine_reasons(spark):
    values = ["not json", '{"payload":{"op":"c","after":{"id":1', '{"payload":{"ts_ms":1}}', '{"payload":{"op":"t"}}',
              '{"payload":{"op":"m"}}', envelope("c", 1, after={"name": "n"}), envelope("c", 1, after={"id": "x"}),
              envelope("c", 1, after={"id": 0}), envelope("d", 1, before={"id": 2}), None]
    df = log(spark, [message(i, v) for i, v in enumerate(values)])
    expected = {(0, "unparseable"), (1, "unparseable"), (2, "missing_op"), (3, "truncate"), (4, "unknown_op"),
                (5, "missing_key"), (6, "bad_key")}
    assert rows(E.quarantine(df, [PEOPLE]).select("kafka_offset", "reason")) == expected
    assert rows(E.quarantined(E.bronze_table(df, PEOPLE), PEOPLE).select("kafka_offset", "reason")) == expected
    assert [r.value for r in E.quarantine(df, [PEOPLE]).filter("kafka_offset = 0").collect()] == ["not json"]


def test_undeclared_table_keeps_its_fields(spark):
    df = log(spark, [message(0, envelope("c", 1, after={"a": 1, "b": {"c": True}}), "unknown")])
    assert E.parse_envelope(df).first().after == {"a": "1", "b": '{"c":true}'}


def test_new_source_column(spark):
    wide = PEOPLE.with_column("phone", T.StringType())
    df = log(spark, [message(0, envelope("c", 1, after={"id": 1, "name": "Old"})),
                     message(1, envelope("c", 2, after={"id": 2, "name": "New", "phone": "123"}))])
    narrow = E.bronze_table(df, PEOPLE)
    assert rows(current_state(E.evolve(narrow, wide), wide)) == {(1, "Old", None, 1), (2, "New", None, 2)}
    assert rows(current_state(E.reparse(narrow, wide), wide)) == {(1, "Old", None, 1), (2, "New", "123", 2)}


def test_envelope_round_trip(spark):
    bronze = E.bronze_table(logs.edge_log(spark), PEOPLE)
    again = E.bronze_table(to_envelope(bronze, PEOPLE, False), PEOPLE)
    assert rows(again.drop("value", "kafka_timestamp")) == rows(bronze.drop("value", "kafka_timestamp"))


def test_offset_ranges(spark):
    df = log(spark, [message(o, "{}", "people", p) for p in range(3) for o in range(5)])
    topic = PEOPLE.topic
    read = L.read_offsets(df, {(topic, 0): 3, (topic, 2): 9}, {(topic, 0): 1})
    assert rows(read.select("partition", "offset")) == {(0, 1), (0, 2)} | {(2, o) for o in range(5)}
    assert L.read_offsets(df, {}).count() == 0
    many = {(f"t{i}", 0): 9 for i in range(300)} | {(topic, 1): 2}
    assert rows(L.read_offsets(df, many).select("partition", "offset")) == {(1, 0), (1, 1)}


def test_checkpoint_batches(spark, tmp_path):
    events = [{"offset": o, "value": envelope("c", o, after={"id": o, "name": str(o)})} for o in (12, 13)]
    (tmp_path / "bronze_1.json").write_text(json.dumps({"from": 12, "to": 14, "events": events}, indent=1))
    (tmp_path / "bronze_2.json").write_text(json.dumps({"from": 14, "to": 14, "events": []}))
    read = L.read_checkpoint_batches(spark, str(tmp_path), PEOPLE.topic, 0)
    assert rows(current_state(E.bronze_table(read, PEOPLE), PEOPLE)) == {(12, "12", 12), (13, "13", 13)}


def test_base64_is_decoded_once(spark):
    from tidemark.functions.values import decimal_from_base64

    texts = ["AV8=", "/qE=", "AA==", "", "!", None, "AAAAAAAAAAAAAAAAAAAAAAAAAA==", "f////////////////////w=="]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(decimal_from_base64(F.col("t"), 2).alias("d"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("unbase64") == 1
    shown = [None if r.d is None else r.d.lstrip("0") for r in df.collect()]
    assert shown[:6] == ["3.51", "-" + "0" * 37 + "3.51", ".00", None, None, None] and shown[6] is None and shown[7] is None
