"""The queries in SQL, from the definitions and by other means than the operators.

Latest events are those with the greatest order number of their user, ranks are counts of better rows, modes are values
that no other value beats, and clean trips are those of which no rule of the table below is broken.
"""

from __future__ import annotations

from tidemark.plans.queries import DAY_8, DAY_15, DAY_22
from tidemark.plans.testbed import LOST_K, UNKNOWN_K

_FOREVER = 1 << 62

_EVENTS = f"""ev AS (
  SELECT *, ts_ms * 10000000000::HUGEINT + event_id AS place,
         op IN ('c', 'r', 'u', 'd') AND (op = 'd' OR k <> {LOST_K}) AS usable
  FROM (SELECT event_id, CASE k % 3 WHEN 0 THEN 1 ELSE user_id END AS user_id, event_type, value AS amount, ts, k,
               CASE WHEN k = {UNKNOWN_K} THEN 'm'
                    ELSE coalesce(map {{'signup': 'c', 'view': 'r', 'error': 'd'}}[event_type], 'u') END AS op,
               epoch_us(ts) // 1000 AS arrived_ms,
               epoch_us(ts) // 1000 - CASE k % 10 WHEN 3 THEN 432000000 WHEN 7 THEN 3600000 ELSE 0 END AS ts_ms
        FROM (SELECT *, CAST(props ->> '$.k' AS INT) AS k FROM events)))"""

_TRIPS = """trips AS (
  SELECT event_id AS trip_id, CAST(user_id % {zones} AS INT) AS PULocationID, CAST(k % 30 AS INT) AS DOLocationID,
         amount - 1.0 AS fare_amount,
         CASE WHEN event_type = 'view' THEN 0.0 WHEN event_type = 'error' AND k < 10 THEN -1.0
              ELSE amount * k / 300 END AS tip_amount,
         CAST(CASE WHEN k % 17 <> 0 THEN k % 6 END AS INT) AS payment_type, k / CAST(10 AS DOUBLE) AS trip_distance,
         ts AS tpep_pickup_datetime, ts + to_minutes(k - 5) AS tpep_dropoff_datetime,
         CAST(k % 7 AS BIGINT) AS passenger_count, CASE WHEN k > 50 THEN amount END AS total_amount
  FROM ev)"""

#: What breaks a rule; a missing value breaks the rule on presence only.
_BROKEN = {
    "fare_present": "fare_amount IS NULL",
    "tip_present": "tip_amount IS NULL",
    "distance_present": "trip_distance IS NULL",
    "pickup_present": "tpep_pickup_datetime IS NULL",
    "dropoff_present": "tpep_dropoff_datetime IS NULL",
    "dropoff_not_before_pickup": "tpep_dropoff_datetime < tpep_pickup_datetime",
    "fare_positive": "fare_amount <= 0",
    "tip_not_negative": "tip_amount < 0",
    "distance_positive": "trip_distance <= 0",
}

_SILVER = """verdicts AS (SELECT *, list_filter([{broken}], lambda x: x IS NOT NULL) AS faults FROM trips),
silver AS (
  SELECT * EXCLUDE (faults), (epoch(date_trunc('second', tpep_dropoff_datetime))
                              - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS trip_duration_minutes,
         trip_distance / nullif(greatest(trip_duration_minutes, 0) / 60.0, 0) AS trip_speed_kmh
  FROM verdicts WHERE len(faults) = 0)""".format(
    broken=", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _BROKEN.items()))

_TIPS = """tips AS (
  SELECT *, CAST(date_part('hour', tpep_pickup_datetime) AS INT) AS pickup_hour,
         date_trunc('day', tpep_pickup_datetime)::DATE AS trip_date, 100 * (tip_amount / fare_amount) AS tip_pct
  FROM silver)"""


def _with_events(query: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_EVENTS, *ctes]) + "\n" + query


def _with_trips(query: str, *ctes: str, zones: int = 25) -> str:
    return _with_events(query, _TRIPS.format(zones=zones), _SILVER, _TIPS, *ctes)


def _latest(name: str = "latest", where: str = "TRUE", place: str = "place") -> str:
    """The event of greatest order number per user, among usable ones of a kind."""
    return f"""{name} AS (
  SELECT * FROM ev WHERE usable AND ({where})
  AND (user_id, {place}) IN (SELECT (user_id, max({place})) FROM ev WHERE usable AND ({where}) GROUP BY user_id))"""


def _state(name: str, where: str) -> str:
    return _latest(f"{name}_all", where) + f""",
{name} AS (SELECT user_id AS id, event_type, amount FROM {name}_all WHERE op <> 'd')"""


_MIRROR = "SELECT user_id AS id, event_type, amount, ts_ms AS updated_ts FROM latest WHERE op <> 'd'"

_CUSTOMER = """CAST(user_id AS INT) AS id, 'user-' || user_id AS name, event_id || '@example.com' AS email,
       'country-' || k AS country"""

_DRIVER = """CAST(user_id AS INT) AS id, 'user-' || user_id AS name, 'TLC-' || event_id AS license_number,
       k / CAST(20 AS DOUBLE) AS rating, 'city-' || k AS city, k >= 50 AS active"""

_TABLE_OF = "['customers', 'drivers'][1 + user_id % 2]"
_TOPIC_OF = f"'dbserver1.public.' || {_TABLE_OF}"
_PARTITION_OF = "CAST(user_id % 4 AS INT)"

_MIRROR_OF = "SELECT {columns}, ts_ms AS updated_ts FROM latest WHERE op <> 'd' AND user_id % 2 = {half}"

_MESSAGES = f"""msgs AS (
  SELECT {_TOPIC_OF} AS topic, {_PARTITION_OF} AS kafka_partition, arrived_ms, event_id * 2 AS "offset" FROM ev
  UNION ALL
  SELECT {_TOPIC_OF}, {_PARTITION_OF}, arrived_ms, event_id * 2 + 1 FROM ev WHERE op = 'd')"""

_GATE = f"""gate AS (
  SELECT topic, kafka_partition, coalesce(max(CASE WHEN arrived_ms < {DAY_15} THEN "offset" END) + 1, 0) AS from_offset,
         max("offset") + 1 AS to_offset
  FROM msgs GROUP BY topic, kafka_partition)"""


def _reached(at: int) -> str:
    """Whether an event of the users' log came before the offsets reached by a time."""
    return (f"event_id <= (SELECT max(x.event_id) FROM ev x WHERE x.user_id % 4 = ev.user_id % 4 "
            f"AND x.arrived_ms < {at})")


#: What became of damaged messages, by k; a rest that lost its images or has an unknown operation is listed as well.
_REASON = f"""CASE k WHEN 7 THEN 'unparseable' WHEN 11 THEN 'unparseable' WHEN 13 THEN 'truncate'
    WHEN 17 THEN 'unknown_op' WHEN 19 THEN 'missing_key' WHEN 23 THEN 'bad_key' WHEN 29 THEN 'missing_op'
    WHEN {UNKNOWN_K} THEN 'unknown_op' WHEN {LOST_K} THEN CASE WHEN op <> 'd' THEN 'missing_key' END END"""

_FLAGS = "avg(CASE WHEN {} THEN 100.0 ELSE 0.0 END)"

_MODES = """paid AS (
  SELECT PULocationID, pickup_hour, payment_type, count(*) AS frequency FROM tips WHERE tip_pct > 20
  GROUP BY PULocationID, pickup_hour, payment_type),
modes AS (
  SELECT a.* FROM paid a WHERE NOT EXISTS (
    SELECT 1 FROM paid b WHERE b.PULocationID = a.PULocationID AND b.pickup_hour = a.pickup_hour
    AND (b.frequency > a.frequency OR (b.frequency = a.frequency
         AND coalesce(b.payment_type, -1) < coalesce(a.payment_type, -1)))))"""

_BEHAVIOR = _MODES + f""",
behavior AS (
  SELECT PULocationID, pickup_hour, avg(tip_amount) AS avg_tip_amount, avg(tip_pct) AS avg_tip_percentage,
         {_FLAGS.format('tip_amount = 0')} AS pct_zero_tip, {_FLAGS.format('tip_pct > 20')} AS pct_high_tip,
         (SELECT payment_type FROM modes WHERE modes.PULocationID = tips.PULocationID
          AND modes.pickup_hour = tips.pickup_hour) AS high_tip_common_payment_type, count(*) AS trips_count
  FROM tips GROUP BY PULocationID, pickup_hour)"""

_BEHAVIOR_COLUMNS = """PULocationID, pickup_hour, round(avg_tip_amount, 9) AS avg_tip_amount,
  round(avg_tip_percentage, 9) AS avg_tip_percentage, round(pct_zero_tip, 9) AS pct_zero_tip,
  round(pct_high_tip, 9) AS pct_high_tip"""


def _best(of: str, value: str, n: int, *ties: str) -> str:
    """Rows that fewer than n others beat: by a greater value, or a smaller tie-breaker at the same."""
    same, beats = f"b.{value} = a.{value}", [f"b.{value} > a.{value}"]
    for tie in ties:
        beats.append(f"({same} AND b.{tie} < a.{tie})")
        same += f" AND b.{tie} = a.{tie}"
    return f"(SELECT a.* FROM {of} a WHERE (SELECT count(*) FROM {of} b WHERE {' OR '.join(beats)}) < {n})"


_PLACES = """daily AS (SELECT trip_date, PULocationID, avg(tip_pct) AS pct FROM tips GROUP BY trip_date, PULocationID),
placed AS (
  SELECT a.trip_date, a.PULocationID, any_value(a.pct) AS pct,
         count(*) FILTER (WHERE b.pct > a.pct OR (b.pct = a.pct AND b.PULocationID < a.PULocationID)) AS better,
         count(*) FILTER (WHERE b.pct < a.pct OR (b.pct = a.pct AND b.PULocationID < a.PULocationID)) AS worse
  FROM daily a JOIN daily b ON a.trip_date = b.trip_date GROUP BY a.trip_date, a.PULocationID),
hourly AS (SELECT trip_date, pickup_hour, avg(tip_pct) AS pct FROM tips GROUP BY trip_date, pickup_hour),
peaks AS (SELECT * FROM hourly a WHERE NOT EXISTS (
  SELECT 1 FROM hourly b WHERE b.trip_date = a.trip_date
  AND (b.pct > a.pct OR (b.pct = a.pct AND b.pickup_hour < a.pickup_hour))))"""


def _ranking(both: bool) -> str:
    shown = "['top10', 'bottom10']" if both else "[CASE WHEN better < 10 THEN 'top10' ELSE 'bottom10' END]"
    return f"""
SELECT CAST(trip_date AS VARCHAR) AS trip_date, ranking_bucket, PULocationID, round(placed.pct, 9) AS avg_tip_pct,
       peaks.pickup_hour AS best_hour_global, round(peaks.pct, 9) AS best_hour_avg_tip_pct
FROM (SELECT *, unnest({shown}) AS ranking_bucket FROM placed WHERE better < 10 OR worse < 10) placed
JOIN peaks USING (trip_date)
WHERE CASE ranking_bucket WHEN 'top10' THEN better ELSE worse END < 10"""


def _report(drivers: str = "SELECT s_suppkey AS id, s_acctbal AS rating, s_suppkey - 1 AS turn FROM supplier") -> str:
    """Each driver's trips are those whose number leaves the driver's turn over when dealt out."""
    return f"""drivers AS ({drivers}),
report AS (
  SELECT any_value(id) AS driver_id, any_value(rating) AS driver_rating, avg(tip_amount) AS avg_tip_amount,
         avg(tip_pct) AS avg_tip_pct, count(*) AS trips_count
  FROM tips, drivers, (SELECT count(*) AS n FROM drivers) WHERE trip_id % n = turn GROUP BY turn)"""


_REPORT_COLUMNS = """driver_id, driver_rating, round(avg_tip_amount, 9) AS avg_tip_amount,
  round(avg_tip_pct, 9) AS avg_tip_pct, trips_count FROM report"""

_CLEAN_COLUMNS = """trip_id, PULocationID, DOLocationID, fare_amount, tip_amount, payment_type, trip_distance,
  epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime, epoch_us(tpep_dropoff_datetime) AS tpep_dropoff_datetime,
  trip_duration_minutes, trip_speed_kmh"""

_EVENT_TRIPS = """SELECT PULocationID AS VendorID, epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime,
  epoch_us(tpep_dropoff_datetime) AS tpep_dropoff_datetime, PULocationID, DOLocationID, payment_type,
  trip_distance, fare_amount, tip_amount, passenger_count, total_amount FROM trips"""


def _rejects() -> str:
    rows = [f"SELECT '{rule}' AS measure, count(*) AS trips FROM verdicts WHERE list_contains(faults, '{rule}')" for rule in _BROKEN]
    rows += ["SELECT 'all_trips', count(*) FROM trips", "SELECT 'kept_trips', count(*) FROM silver"]
    return (f"SELECT measure, trips, round(100.0::DOUBLE * trips / (SELECT count(*) FROM trips), 9) AS pct_of_all "
            f"FROM ({' UNION ALL '.join(rows)})")


def _counts(column: str, **sources: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS {column}, count(*) AS rows FROM {source}" for name, source in sources.items())


_RUN_SUMMARY = """
SELECT count(*) AS events_read, min(event_id) AS from_offset, max(event_id) + 1 AS to_offset,
       count(*) FILTER (WHERE usable) AS applied, (SELECT count(*) FROM latest WHERE op <> 'd') AS live_rows
FROM ev"""

_ROW_DIFF = """
(SELECT *, CAST(1 AS BIGINT) AS in_a, CAST(0 AS BIGINT) AS in_b FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n))
UNION ALL (SELECT *, 0, 1 FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o))"""

#: Events of the first of two runs, and those of the second within two days of the latest event of their partition before.
_IN_TIME = (f"arrived_ms < {DAY_15} OR ts_ms >= (SELECT max(x.ts_ms) - 172800000 FROM ev x "
            f"WHERE x.user_id % 4 = ev.user_id % 4 AND x.arrived_ms < {DAY_15})")


def oracle_sql() -> dict[str, str]:
    latest = _latest()
    live_of = {half: f"latest WHERE op <> 'd' AND user_id % 2 = {half}" for half in (0, 1)}
    every = ("id", "name", "license_number", "rating", "city", "active", "email", "country")
    images = ", ".join(f"CASE WHEN {shown} THEN {c} END AS {side}_{c}" for c in every
                       for side, shown in (("after", f"op <> 'd' AND k <> {LOST_K}"), ("before", "op = 'd'")))
    after, before = f"CASE WHEN op <> 'd' AND k <> {LOST_K} THEN {{}} END", "CASE WHEN op = 'd' THEN {} END"
    return {
        "cdc_parse_envelope": _with_events(f"""
SELECT {_TOPIC_OF} AS topic, {_PARTITION_OF} AS kafka_partition, event_id * 2 AS kafka_offset,
       epoch_us(ts) AS kafka_timestamp, {_TABLE_OF} AS source_table, op, ts_ms, event_id AS source_lsn, {images}
FROM (SELECT * EXCLUDE (email, country), NULL AS email, NULL AS country
      FROM (SELECT *, {_DRIVER}, NULL AS email, NULL AS country FROM ev) WHERE user_id % 2 = 1
      UNION ALL BY NAME
      SELECT *, {_CUSTOMER} FROM ev WHERE user_id % 2 = 0)"""),
        "cdc_route_counts": _with_events(f"SELECT {_TABLE_OF} AS source_table, count(*) AS events FROM ev GROUP BY 1"),
        "cdc_undeclared_table": _with_events(f"""
SELECT CASE WHEN op = 'd' OR k <> {LOST_K} THEN 'country-' || k END AS country, count(*) AS events,
       min(CASE WHEN op = 'd' OR k <> {LOST_K} THEN event_id || '@example.com' END) AS first_email
FROM ev WHERE user_id % 2 = 0 GROUP BY 1"""),
        "cdc_quarantine": _with_events(f"""
SELECT * FROM (SELECT {_TOPIC_OF} AS topic, {_PARTITION_OF} AS kafka_partition, event_id * 2 AS kafka_offset,
                      {_REASON} AS reason, TRUE AS raw_kept FROM ev) WHERE reason IS NOT NULL"""),
        "cdc_all_accounted": _with_events(f"""
SELECT topic, unnest(['applied', 'quarantine', 'tombstone', 'all']) AS part,
       unnest([count(*) FILTER (WHERE reason IS NULL), count(reason), count(*) FILTER (WHERE op = 'd'),
               count(*) + count(*) FILTER (WHERE op = 'd')]) AS n
FROM (SELECT {_TOPIC_OF} AS topic, op, {_REASON} AS reason FROM ev) GROUP BY topic"""),
        "cdc_quarantined_bronze": _with_events(f"""
SELECT source_table, reason, count(*) AS messages FROM (SELECT {_TABLE_OF} AS source_table, {_REASON} AS reason FROM ev)
WHERE reason IS NOT NULL GROUP BY source_table, reason"""),
        "cdc_mirror_customers": _with_events(_MIRROR_OF.format(columns=_CUSTOMER, half=0), latest),
        "cdc_mirror_drivers": _with_events(_MIRROR_OF.format(columns=_DRIVER, half=1), latest),
        "cdc_new_table_later": _with_events(_MIRROR_OF.format(columns=_DRIVER, half=1), latest),
        "cdc_backfill": _with_events(_MIRROR_OF.format(columns=_CUSTOMER, half=0), latest),
        "cdc_incremental_run": _with_events(f"""
SELECT 'live customers' AS part, count(*) AS n FROM {live_of[0]} UNION ALL SELECT 'live drivers', count(*) FROM {live_of[1]}
UNION ALL SELECT 'run 0', count(*) FROM ev WHERE arrived_ms < {DAY_8}
UNION ALL SELECT 'run 1', count(*) FROM ev WHERE arrived_ms BETWEEN {DAY_8} AND {DAY_22} - 1
UNION ALL SELECT 'run 2', count(*) FROM ev WHERE arrived_ms >= {DAY_22}""", latest),
        "cdc_decimal_widths": """
SELECT CAST(l_linenumber % 5 AS INT) AS width, count(*) AS values, count(*) AS equal FROM lineitem GROUP BY 1""",
        "cdc_wide_topic": _with_events("""
SELECT CAST("offset" % 500 AS INT) AS partition, count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset
FROM msgs JOIN (SELECT "offset" % 500 AS p, min("offset") AS low, max("offset") AS high FROM msgs
                WHERE topic = 'dbserver1.public.customers' GROUP BY 1) ON "offset" % 500 = p
WHERE topic = 'dbserver1.public.customers' AND p < 400 AND "offset" >= low + (high - low) // 5
AND "offset" < high - (high - low) // 5 GROUP BY 1""", _MESSAGES),
        "cdc_string_keys": _with_events("""
SELECT 'live' AS part, count(*) AS n FROM latest WHERE op <> 'd'
UNION ALL SELECT 'quarantine', count(*) FROM ev WHERE NOT usable""", latest),
        "cdc_batches_two_partitions": _with_events("""
SELECT CAST(event_id % 2 AS INT) AS kafka_partition, count(*) AS events, max(event_id // 2) AS last_offset FROM ev GROUP BY 1"""),
        "cdc_current_state": _with_events(_MIRROR, latest),
        "cdc_first_rows": _with_events(f"SELECT * FROM ({_MIRROR}) ORDER BY id LIMIT 5", latest),
        "cdc_latest_ties": _with_events("""
SELECT user_id AS id, event_type, amount, ts_ms - ts_ms % 86400000 AS updated_ts FROM latest WHERE op <> 'd'""",
                                        _latest(place="((ts_ms // 86400000)::HUGEINT * 10000000000 + event_id)")),
        "cdc_apply_changes": _with_events(_MIRROR, latest),
        "cdc_variant_table": _with_events(_MIRROR, latest),
        "cdc_crashed_merge": _with_events(_MIRROR, latest),
        "cdc_replay_equals_batch": _with_events(_MIRROR, latest),
        "cdc_state_as_of": _with_events(_MIRROR, _latest(where=f"ts_ms < {DAY_15}")),
        "cdc_state_as_of_offsets": _with_events(_MIRROR, _latest(where=_reached(DAY_15))),
        "cdc_deleted_keys": _with_events("SELECT user_id AS id, ts_ms AS deleted_ts FROM latest WHERE op = 'd'", latest),
        "cdc_resurrected_keys": _with_events(
            "SELECT user_id AS id FROM latest WHERE op = 'd' INTERSECT SELECT id FROM earlier",
            latest, _state("earlier", f"ts_ms < {DAY_15}")),
        "cdc_offset_order": _with_events(_MIRROR, _latest(place="event_id")),
        "cdc_run_summary": _with_events(_RUN_SUMMARY, latest),
        "cdc_observed_run": _with_events(_RUN_SUMMARY, latest),
        "cdc_snapshot_diff": _with_events("""
SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op, coalesce(n.id, o.id) AS id,
       o.event_type AS before_event_type, o.amount AS before_amount,
       n.event_type AS after_event_type, n.amount AS after_amount
FROM o FULL JOIN n ON o.id = n.id WHERE (o.id, o.event_type, o.amount) IS DISTINCT FROM (n.id, n.event_type, n.amount)""",
                                          _state("o", f"ts_ms < {DAY_8}"), _state("n", f"ts_ms < {DAY_22}")),
        "cdc_diff_applied": _with_events("SELECT id, event_type, amount FROM n", _state("n", f"ts_ms < {DAY_22}")),
        "cdc_pending_offsets": _with_events(
            "SELECT *, to_offset - from_offset AS new_events FROM gate", _MESSAGES, _GATE),
        "cdc_offset_range": _with_events("""
SELECT topic, kafka_partition AS partition, count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset
FROM msgs JOIN gate USING (topic, kafka_partition) WHERE "offset" BETWEEN from_offset AND to_offset - 1
GROUP BY topic, kafka_partition""", _MESSAGES, _GATE),
        "cdc_checkpoint_batches": _with_events(f"""
SELECT {_TOPIC_OF} AS topic, {_PARTITION_OF} AS kafka_partition, event_id * 2 AS kafka_offset, op,
       CAST({after.format('user_id')} AS INT) AS after_id, {after.format("'user-' || user_id")} AS after_name,
       CAST({before.format('user_id')} AS INT) AS before_id FROM ev"""),
        "cdc_reconcile": _with_events("""
SELECT id, 'missing' AS status, NULL AS columns, amount AS source_amount, CAST(NULL AS DOUBLE) AS mirror_amount
FROM live WHERE amount < 5
UNION ALL SELECT id, 'changed', 'amount', amount, amount + 1 FROM live WHERE amount >= 5 AND amount < 20
UNION ALL SELECT id + 1000000, 'extra', NULL, NULL, amount FROM live WHERE event_type = 'view'""", _state("live", "TRUE")),
        "cdc_row_diff": _with_events(_ROW_DIFF, _state("o", f"ts_ms < {DAY_15}"), _state("n", f"ts_ms < {DAY_22}")),
        "cdc_bucket_diff": _with_events(_ROW_DIFF, _state("o", f"ts_ms < {DAY_15}"), _state("n", f"ts_ms < {DAY_22}")),
        "cdc_marker_horizon": _with_events(f"""
SELECT CASE op WHEN 'd' THEN 'marker' ELSE 'live' END AS part, user_id AS id, ts_ms FROM held_latest
WHERE op <> 'd' OR ts_ms >= (SELECT max(x.ts_ms) - 172800000 FROM ev x WHERE x.user_id % 4 = held_latest.user_id % 4)
UNION ALL SELECT 'too_late', user_id, ts_ms FROM ev WHERE usable AND NOT ({_IN_TIME})""",
                                           _latest("held_latest", _IN_TIME)),
        "cdc_delta_mirror": _with_events(f"""
SELECT user_id AS id, event_type, amount, ts_ms AS updated_ts, 'run 1' AS phase FROM early WHERE op <> 'd'
UNION ALL SELECT *, unnest(['before', 'after']) FROM ({_MIRROR})""", _latest("early", f"arrived_ms < {DAY_22}"), latest),
        "cdc_schema_evolution": _with_events(f"""
SELECT user_id AS id, event_type, amount, CASE WHEN ts_ms >= {DAY_15} THEN '+1-' || event_id END AS phone,
       ts_ms AS updated_ts FROM latest WHERE op <> 'd'""", latest),
        "cdc_reparse": _with_events("""
SELECT CAST(user_id AS INT) AS id, 'user-' || user_id AS name, ts_ms AS updated_ts FROM latest WHERE op <> 'd'""", latest),
        "quality_counts": _with_events(
            "SELECT count(*) + 1 AS source_rows, count(*) AS mirror_rows FROM latest WHERE op <> 'd'", latest),
        "quality_describe": """
SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS "column", map {
  'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'VARCHAR': 'string', 'DATE': 'date', 'TIMESTAMP': 'timestamp_ntz'
}[column_type] AS type FROM (DESCRIBE lineitem)""",
        "source_trip_files": _with_trips("""
SELECT count(*) AS trips, count(total_amount) FILTER (WHERE trip_id % 3 <> 0) AS with_total,
       CAST(sum(passenger_count) AS BIGINT) AS passengers FROM trips"""),
        "source_drifted_files": _with_trips("""
SELECT CAST(trip_id % 5 AS VARCHAR) AS kind, count(*) AS trips, count(p) AS known, CAST(sum(p) AS BIGINT) AS passengers,
       (SELECT count(*) FROM silver WHERE silver.trip_id % 5 = any_value(given.trip_id % 5)) AS clean
FROM (SELECT trip_id, CASE WHEN trip_id % 5 <> 4 AND trip_id % 25 NOT IN (1, 2) THEN passenger_count END AS p FROM trips) given
GROUP BY trip_id % 5
UNION ALL SELECT 'passenger_count ' || ['double', 'string'][trip_id % 25], count(*), NULL, NULL, NULL
FROM trips WHERE trip_id % 25 IN (1, 2) GROUP BY trip_id % 25"""),
        "source_lookups": """
SELECT c_custkey, lower(c_name) AS name, c_name AS source_name FROM customer WHERE c_nationkey > 3""",
        "trips_text_times": _with_trips("""
SELECT trip_id, epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime, fare_amount FROM silver WHERE trip_id % 50 <> 0"""),
        "trips_clean": _with_trips(f"SELECT {_CLEAN_COLUMNS} FROM silver"),
        "trips_rejects": _with_trips(_rejects()),
        "trips_enriched": _with_trips(f"""
SELECT {_CLEAN_COLUMNS}, (SELECT n_name FROM nation WHERE n_nationkey = PULocationID) AS pickup_zone,
  (SELECT n_name FROM nation WHERE n_nationkey = DOLocationID) AS dropoff_zone FROM silver"""),
        "trips_events_roundtrip": _with_trips(_EVENT_TRIPS),
        "trips_bad_lines": _with_trips("""
SELECT CASE WHEN trip_id % 5 = 0 THEN 'unparseable' END AS reason, count(*) AS messages,
       count(*) FILTER (WHERE trip_id % 5 = 0) AS with_text, count(*) FILTER (WHERE trip_id % 5 <> 0) AS with_fare
FROM trips GROUP BY 1"""),
        "trips_event_text": _with_trips("""
SELECT CAST(trip_id AS VARCHAR) AS key, '{"trip_id":' || trip_id || ',"payment_type":' || coalesce(payment_type::VARCHAR, 'null')
       || ',"tpep_pickup_datetime":"' || replace(strftime(tpep_pickup_datetime, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '')
       || '"}' AS value FROM trips"""),
        "ids_dense": _with_trips("""
SELECT rank() OVER (ORDER BY tpep_pickup_datetime) - 1 AS trip_id, epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime,
       fare_amount FROM trips"""),
        "ids_batches": _with_trips("""
SELECT CASE WHEN tpep_pickup_datetime < '2024-01-15' THEN 1 ELSE 2 END AS batch, rank() OVER (ORDER BY tpep_pickup_datetime) - 1 AS trip_id,
       epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime, fare_amount FROM trips"""),
        "ids_hash": _with_trips("""
SELECT 'rows' AS layer, 2 * count(*) AS rows FROM trips UNION ALL SELECT 'ids', count(*) FROM trips
UNION ALL SELECT 'ids_in_any_order', count(*) FROM trips"""),
        "ids_fast": _with_trips("SELECT 2 * count(*) AS rows, 2 * count(*) AS ids FROM trips"),
        "layer_counts": _with_trips(_counts("layer", bronze="trips", silver="silver")),
        "trips_appended": _with_trips(_counts("layer", bronze="trips", ids="trips", silver="silver")),
        "tips_behavior": _with_trips(
            f"SELECT {_BEHAVIOR_COLUMNS}, high_tip_common_payment_type, trips_count FROM behavior", _BEHAVIOR),
        "tips_mode_payment": _with_trips("SELECT * FROM modes", _MODES),
        "tips_rankings": _with_trips(_ranking(False), _PLACES),
        "tips_rankings_overlap": _with_trips(_ranking(False), _PLACES, zones=15),
        "tips_rankings_both": _with_trips(_ranking(True), _PLACES, zones=15),
        "tips_best_zone_hour": _with_trips(
            f"SELECT PULocationID, pickup_hour, round(pct, 9) AS avg_tip_pct FROM {_best('zh', 'pct', 1, 'PULocationID', 'pickup_hour')}",
            "zh AS (SELECT PULocationID, pickup_hour, avg(tip_pct) AS pct FROM tips GROUP BY ALL)"),
        "tips_top15": _with_trips(
            f"SELECT {_BEHAVIOR_COLUMNS} FROM {_best('behavior', 'avg_tip_percentage', 15, 'PULocationID', 'pickup_hour')}", _BEHAVIOR),
        "tips_top20": _with_trips(f"""
SELECT {_BEHAVIOR_COLUMNS}, high_tip_common_payment_type, trips_count
FROM {_best('behavior', 'avg_tip_percentage', 20, 'PULocationID', 'pickup_hour')}""", _BEHAVIOR),
        "tips_best_hour": _with_trips(f"SELECT pickup_hour, round(pct, 9) AS avg_tip_pct FROM {_best('h', 'pct', 1, 'pickup_hour')}",
                                      "h AS (SELECT pickup_hour, avg(tip_pct) AS pct FROM tips GROUP BY ALL)"),
        "tips_driver_report": _with_trips(f"SELECT {_REPORT_COLUMNS}", _report()),
        "tips_driver_report_dense": _with_trips(f"SELECT {_REPORT_COLUMNS}", _report("""
SELECT s_suppkey AS id, s_acctbal AS rating, (SELECT count(*) FROM supplier o WHERE o.s_suppkey < s.s_suppkey) AS turn
FROM supplier s""")),
        "tips_top_drivers": _with_trips(f"""
SELECT {_REPORT_COLUMNS.replace('FROM report', '')} FROM (
  SELECT a.* FROM report a WHERE (
    SELECT count(*) FROM report b WHERE b.driver_rating > a.driver_rating OR (b.driver_rating = a.driver_rating
      AND (b.avg_tip_pct > a.avg_tip_pct OR (b.avg_tip_pct = a.avg_tip_pct AND b.driver_id < a.driver_id)))) < 20)""", _report()),
        "tips_driver_by_key": """
SELECT s_suppkey AS driver_id, s_acctbal AS rating, (
  SELECT round(avg(100 * (l_extendedprice * l_discount) / nullif(greatest(l_extendedprice, 0), 0)), 9)
  FROM lineitem WHERE l_suppkey = s_suppkey) AS avg_tip_pct
FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
        "tips_rating_vs_tip": _with_trips("""
SELECT driver_rating, round(sum(avg_tip_pct) / count(*), 9) AS mean_tip_pct, count(*) AS drivers FROM report GROUP BY driver_rating""",
                                          _report("SELECT s_suppkey AS id, CAST(floor(s_acctbal / 1000) AS BIGINT) AS rating, s_suppkey - 1 AS turn FROM supplier")),
        "tips_rating_correlation": _with_trips("""
SELECT round((avg(driver_rating * avg_tip_pct) - avg(driver_rating) * avg(avg_tip_pct))
             / (stddev_pop(driver_rating) * stddev_pop(avg_tip_pct)), 9) AS correlation, count(*) AS drivers FROM report""", _report()),
        "table_versions": _with_events(f"""
SELECT CAST(run AS BIGINT) AS run, operation, CAST((SELECT sum(m) FROM (
         SELECT max(event_id) + 1 AS m FROM ev WHERE arrived_ms < upto GROUP BY user_id % 4)) AS BIGINT) AS offsets
FROM (VALUES (0, 'refresh', {DAY_8}), (1, 'refresh', {DAY_22}), (2, 'refresh', {_FOREVER}), (3, 'rollback', {DAY_22})) v(run, operation, upto)"""),
        "table_as_of": _with_events("""
SELECT user_id AS id, event_type, amount, ts_ms AS updated_ts, 0 AS version FROM early WHERE op <> 'd'
UNION ALL SELECT user_id, event_type, amount, ts_ms, 2 FROM latest WHERE op <> 'd'""",
                                    _latest("early", _reached(DAY_8)), latest),
        "table_as_of_tail": _with_events("""
SELECT user_id AS id, event_type, amount, ts_ms AS updated_ts, 0 AS version FROM early WHERE op <> 'd'
UNION ALL SELECT user_id, event_type, amount, ts_ms, 1 FROM later WHERE op <> 'd'
UNION ALL SELECT user_id, event_type, amount, ts_ms, 2 FROM latest WHERE op <> 'd'""",
                                         _latest("early", _reached(DAY_8)), _latest("later", _reached(DAY_22)), latest),
        "table_rollback": _with_events(_MIRROR, _latest(where=_reached(DAY_22))),
        **{name: _with_events(f"""
SELECT event_id AS kafka_offset, op, {after.format('user_id')} AS after_id, {before.format('user_id')} AS before_id FROM ev""")
           for name in ("table_append_twice", "table_compacted_log")},
        "table_run_overwrite": _with_events("""
SELECT CAST(day AS VARCHAR) AS day, op, count(*) AS events FROM (SELECT ts::DATE AS day, op FROM ev)
WHERE day <> '2024-01-20' AND (op = 'd' OR day >= '2024-01-15') GROUP BY day, op"""),
        "table_offsets": _with_events(f"""
SELECT 'dbserver1.public.users' AS topic, {_PARTITION_OF} AS kafka_partition, max(event_id) + 1 AS next_offset
FROM ev WHERE arrived_ms < {DAY_22} GROUP BY ALL"""),
        "stream_bronze": _with_events(f"""
SELECT {_TOPIC_OF} AS topic, {_PARTITION_OF} AS kafka_partition, event_id * 2 AS kafka_offset, op, ts_ms,
       CAST({after.format('user_id')} AS INT) AS after_id, CAST({before.format('user_id')} AS INT) AS before_id,
       {after.format("'user-' || user_id")} AS after_name FROM ev"""),
        "stream_silver": _with_events(_MIRROR, latest),
        "stream_trips": _with_trips(_EVENT_TRIPS),
        "stream_trips_silver": _with_trips("""
SELECT epoch_us(tpep_pickup_datetime) AS tpep_pickup_datetime, fare_amount, trip_duration_minutes,
  (SELECT n_name FROM nation WHERE n_nationkey = PULocationID) AS pickup_zone,
  (SELECT n_name FROM nation WHERE n_nationkey = DOLocationID) AS dropoff_zone FROM silver"""),
        "medallion_driver_report": _with_trips(f"SELECT {_REPORT_COLUMNS}", latest, _report(
            "SELECT id, rating, id - 1 AS turn FROM "
            f"(SELECT {_DRIVER} FROM latest WHERE op <> 'd' AND user_id % 2 = 1)")),
        "medallion_layers": _with_trips(_counts(
            "layer", bronze_customers="ev WHERE user_id % 2 = 0", bronze_drivers="ev WHERE user_id % 2 = 1",
            silver_customers=live_of[0], silver_drivers=live_of[1], customers_differing="ev WHERE FALSE",
            bronze_trips="trips", silver_trips="silver",
            gold_tipping_behavior="(SELECT DISTINCT PULocationID, pickup_hour FROM tips)",
            gold_tip_rankings="placed WHERE better < 10 OR worse < 10"), latest, _PLACES),
    }
