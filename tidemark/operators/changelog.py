"""Current state from a change log, by full recompute or by incremental merge.

A *state* frame has one row per key: key, attributes, ``ts_ms``, ``kafka_offset``,
``kafka_partition`` and ``deleted``. Deleted keys stay in it as markers, so that an event arriving
late cannot bring a key back. A *mirror* is the public view: live rows only, ``ts_ms`` shown as
``updated_ts``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas as S
from tidemark.operators.envelope import event_key, problem
from tidemark.sources.event_log import Offsets, per_partition, read_offsets

# Later events win. Offsets decide equal times; partitions only make the order total.
ORDER = ("ts_ms", "kafka_offset", "kafka_partition")
OFFSET_ORDER = ("kafka_offset", "kafka_partition")


def latest_per_key(rows: DataFrame, key: str, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The row with the greatest ``order`` for every key; NULL sorts lowest, rows without a key go.

    ``max`` over a struct is combined before the shuffle, so every task sends one row per key however
    many events a hot key has, and one at most for all rows without a key. Those are left out by the
    aggregate and not by a filter: Catalyst would move a filter below the parsing of the log and parse
    every message once more for each column it mentions. The remaining columns follow the order
    columns in the struct and make the choice deterministic when even the order ties.
    """
    names = [*order, *[c for c in rows.columns if c != key and c not in order]]
    best = rows.groupBy(key).agg(F.max(F.when(F.col(key).isNotNull(), F.struct(*names))).alias("_best"))
    return best.filter(F.col("_best").isNotNull()).select(
        *[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def keyed_events(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Events as state rows. One that cannot be applied counts as one without a key."""
    return bronze.select(
        F.when(problem(spec).isNull(), event_key(spec)).alias(spec.key),
        *[F.col(f"after_{name}").alias(name) for name in spec.attributes],
        *ORDER,
        (F.col("op") == S.DELETE).alias("deleted"),
    )


def fold_state(bronze: DataFrame, spec: S.TableSpec, order: tuple[str, ...] = ORDER) -> DataFrame:
    """State after all events, deletion markers included."""
    return latest_per_key(keyed_events(bronze, spec), spec.key, order)


def live_rows(state: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Public view of a state. Deleted keys go only now, after ranking."""
    return state.filter(~F.col("deleted")).select(
        spec.key, *spec.attributes, F.col("ts_ms").alias("updated_ts"))


def current_state(bronze: DataFrame, spec: S.TableSpec, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Mirror by full recompute over the whole log."""
    return live_rows(fold_state(bronze, spec, order), spec)


def apply_changes(state: DataFrame, bronze: DataFrame, spec: S.TableSpec,
                  order: tuple[str, ...] = ORDER) -> DataFrame:
    """State after merging a batch of events into an earlier state.

    Insert, update and delete are one rule: of what is stored and what arrives, the later row wins.
    Batches may therefore come late, out of order or twice. Changes are reduced to one row per key
    map-side, together with the state, in a single shuffle.
    """
    return latest_per_key(state.unionByName(keyed_events(bronze, spec).select(*state.columns)),
                          spec.key, order)


def replay(batches: list[DataFrame], spec: S.TableSpec) -> DataFrame:
    """State from a list of batches merged one after the other."""
    first, *rest = batches
    return reduce(lambda state, batch: apply_changes(state, batch, spec), rest, fold_state(first, spec))


def before_point(bronze: DataFrame, at: int | DataFrame, by: str = "ts") -> DataFrame:
    """Events up to a point.

    ``by="ts"`` keeps ``ts_ms <= at``: what had happened by then, late arrivals included.
    ``by="offset"`` keeps offsets below ``at``: what had arrived by then. A frame of
    (topic, kafka_partition, next_offset), as saved after a run, cuts every partition at its own offset.
    """
    if by == "ts":
        return bronze.filter(F.col("ts_ms") <= at)
    if by != "offset":
        raise ValueError("by must be 'ts' or 'offset'")
    if isinstance(at, DataFrame):
        cut = at.select("topic", "kafka_partition", F.col("next_offset").alias("_next"))
        return (bronze.join(cut, ["topic", "kafka_partition"])
                .filter(F.col("kafka_offset") < F.col("_next")).select(*bronze.columns))
    return bronze.filter(F.col("kafka_offset") < at)


def state_as_of(bronze: DataFrame, spec: S.TableSpec, at: int | DataFrame, by: str = "ts") -> DataFrame:
    """Mirror as of an earlier point; exact because the log is append-only."""
    return current_state(before_point(bronze, at, by), spec)


def state_from(state: DataFrame, reached: Offsets, bronze: DataFrame, spec: S.TableSpec, cut: Offsets) -> DataFrame:
    """State at the offsets ``cut`` from an earlier one that was taken at the offsets ``reached``.

    Only the stretch of the log between the two is read: its bounds are pushed into the scan.
    """
    tail = read_offsets(bronze, cut, reached, "kafka_partition", "kafka_offset")
    return apply_changes(state, tail, spec)


def horizons(bronze: DataFrame, retention_ms: int, known: Offsets | None = None) -> Offsets:
    """Per (topic, partition): event time below which events are no longer taken.

    It lies ``retention_ms`` below the latest event of the partition and never falls. One row per partition comes to
    the driver.
    """
    latest = bronze.groupBy("topic", "kafka_partition").agg(F.max("ts_ms").alias("ts_ms")).filter(F.col("ts_ms").isNotNull())
    found = {(r.topic, r.kafka_partition): r.ts_ms - retention_ms for r in latest.collect()}
    return {p: max(found.get(p, 0), (known or {}).get(p, 0)) for p in {**found, **(known or {})}}


def _too_late(horizon: Offsets) -> Column:
    """Whether a row's time is below the horizon of its partition; one without a time is, if there is a horizon."""
    bound = per_partition(horizon, F.col("topic"), F.col("kafka_partition"))
    return F.coalesce(F.coalesce(F.col("ts_ms"), F.lit(-1)) < bound, F.lit(False))


def split_late(bronze: DataFrame, spec: S.TableSpec, horizon: Offsets) -> tuple[DataFrame, DataFrame]:
    """Events that may be merged, and those refused because they are older than what markers are kept for."""
    late = _too_late(horizon)
    return bronze.filter(~late), bronze.filter(late & problem(spec).isNull()).withColumn("reason", F.lit("too_late"))


def without_old_markers(state: DataFrame, spec: S.TableSpec, horizon: Offsets) -> DataFrame:
    """State without the deletion markers below the horizon of the partition their delete came by.

    Events that such a marker held back are older than it and are refused, provided that a key's events come by one
    partition, as the key's hash sees to.
    """
    rows = state.withColumn("topic", F.lit(spec.topic))
    return rows.filter(~(F.col("deleted") & _too_late(horizon))).drop("topic")


def deleted_keys(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Keys whose latest event is a delete."""
    return fold_state(bronze, spec).filter("deleted").select(spec.key, F.col("ts_ms").alias("deleted_ts"))


def resurrected(deleted: DataFrame, mirror: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Deleted keys that a mirror still shows; empty when deletes were propagated."""
    return deleted.join(mirror, spec.key, "left_semi")


def apply_in_offset_order(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Mirror from applying events strictly in arrival order, whatever their times."""
    return current_state(bronze, spec, OFFSET_ORDER)


def count_applied(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Events read and events applied."""
    usable = problem(spec).isNull()
    return bronze.agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(usable.cast("bigint")), F.lit(0)).alias("applied"))


def snapshot_diff(old: DataFrame, new: DataFrame, spec: S.TableSpec, ts_ms: int, offset: int = 0) -> DataFrame:
    """Changes that turn one snapshot of a table into another, as bronze rows.

    Both snapshots have the spec's columns, one row per key. Every change carries the given time and
    offset, which is enough because a key changes at most once.
    """
    names = spec.columns.names
    left = old.select(F.struct(*names).alias("before"), F.col(spec.key).alias("_k"))
    right = new.select(F.struct(*names).alias("after"), F.col(spec.key).alias("_k"))
    both = left.join(right, "_k", "full_outer")
    op = (F.when(F.col("before").isNull(), S.CREATE)
          .when(F.col("after").isNull(), S.DELETE)
          .when(~F.col("before").eqNullSafe(F.col("after")), S.UPDATE))
    changes = both.withColumn("op", op).filter(F.col("op").isNotNull())
    sides = [(side, name) for side in ("after", "before") for name in [spec.key]]
    sides += [(side, name) for side in ("after", "before") for name in spec.attributes]
    return changes.select(
        F.lit(spec.topic).alias("topic"), F.lit(0).alias("kafka_partition"),
        F.lit(offset).cast("bigint").alias("kafka_offset"),
        F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        F.lit(spec.name).alias("source_table"), "op", F.lit(ts_ms).cast("bigint").alias("ts_ms"),
        F.lit(None).cast("bigint").alias("source_lsn"),
        *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side, name in sides],
        F.lit(None).cast("string").alias("value"))
