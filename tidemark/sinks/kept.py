"""States kept from time to time, from which later points are reached by the tail of the log alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.operators.changelog import fold_state, state_from
from tidemark.sinks.mirrors import state_schema
from tidemark.sinks.runs import load_offsets
from tidemark.sources.event_log import Offsets, read_offsets
from tidemark.sources.files import finished, folders


def keep_state(state: DataFrame, path: str, run: int) -> None:
    """Keep a table's state as a run left it."""
    state.write.mode("overwrite").parquet(f"{path}/run={run}")


def kept_runs(spark: SparkSession, path: str) -> list[int]:
    """Runs whose state is kept, oldest first; one whose write was not finished is none of them."""
    return sorted(int(name.removeprefix("run=")) for name in folders(spark, path) if finished(spark, f"{path}/{name}"))


def reached(spark: SparkSession, runs: str, spec: S.TableSpec, run: int) -> Offsets:
    """Offsets of the table's topic that a run reached; one entry per partition."""
    return {(r.topic, r.kafka_partition): r.next_offset for r in load_offsets(spark, runs, run).collect() if r.topic == spec.topic}


def state_at(bronze: DataFrame, spec: S.TableSpec, cut: Offsets, path: str, runs: str) -> DataFrame:
    """State at the offsets ``cut``, from the latest kept state that lies before them in every partition.

    What is read is that state and the stretch of the log after it. Without such a state the log is read from its
    beginning, up to the cut.
    """
    spark = bronze.sparkSession
    cut = {p: at for p, at in cut.items() if p[0] == spec.topic}
    for run in reversed(kept_runs(spark, path)):
        start = reached(spark, runs, spec, run)
        if all(at <= cut.get(p, 0) for p, at in start.items()):
            state = spark.read.schema(state_schema(spec)).parquet(f"{path}/run={run}")
            return state_from(state, start, bronze, spec, cut)
    return fold_state(read_offsets(bronze, cut, None, "kafka_partition", "kafka_offset"), spec)
