"""Current state as a base and what later runs changed in it.

A merge into buckets rewrites a bucket for one changed key. Here a run adds a delta, one row per key that it touched, and
nothing is rewritten; the state is the latest row per key of the base and the deltas after it. A fold makes a new base of
them once the deltas have grown to a share of the base.

Everything is written under a name nobody has used before and counts once Spark has marked the write as finished. A run
or a fold that dies leaves nothing that counts, and what is read now stays there until it is dropped. One writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas as S
from tidemark.operators.changelog import keyed_events, latest_per_key, live_rows
from tidemark.sinks.mirrors import state_schema
from tidemark.sources.files import finished, folders, remove

# Names: deltas are run=<run>.<attempt>, bases through=<last run in it>.<attempt>.


def _attempts(spark: SparkSession, folder: str, key: str) -> dict[int, list[tuple[int, str]]]:
    """(attempt, path) of every write below ``folder``, finished or not, by run."""
    found: dict[int, list[tuple[int, str]]] = {}
    for name in folders(spark, folder):
        run, _, attempt = name.removeprefix(f"{key}=").partition(".")
        found.setdefault(int(run), []).append((int(attempt), f"{folder}/{name}"))
    return found


def _finished(spark: SparkSession, folder: str, key: str) -> dict[int, str]:
    """Path of the newest finished write of every run that has one."""
    found = {}
    for run, attempts in _attempts(spark, folder, key).items():
        done = [path for _, path in sorted(attempts) if finished(spark, path)]
        if done:
            found[run] = done[-1]
    return found


def _next_path(spark: SparkSession, folder: str, key: str, run: int) -> str:
    tried = [attempt for attempt, _ in _attempts(spark, folder, key).get(run, [])]
    return f"{folder}/{key}={run}.{max(tried, default=-1) + 1}"


def append_delta(bronze: DataFrame, table: str, spec: S.TableSpec, run: int) -> None:
    """Add the latest event per key of a run's batch. Repeating a run replaces its delta and changes nothing else."""
    changes = latest_per_key(keyed_events(bronze, spec), spec.key)
    changes.write.parquet(_next_path(bronze.sparkSession, f"{table}/deltas", "run", run))


def _parts(spark: SparkSession, table: str, spec: S.TableSpec, upto: int | None) -> tuple[int, DataFrame | None, list[str]]:
    """The last run in the base to start from (-1 without one), that base, and the deltas after it, up to a run."""
    bases = {run: path for run, path in _finished(spark, f"{table}/bases", "through").items() if upto is None or run <= upto}
    through = max(bases, default=-1)
    base = spark.read.schema(state_schema(spec)).parquet(bases[through]) if bases else None
    deltas = [path for run, path in sorted(_finished(spark, f"{table}/deltas", "run").items())
              if run > through and (upto is None or run <= upto)]
    return through, base, deltas


def read_state(spark: SparkSession, table: str, spec: S.TableSpec, upto: int | None = None) -> DataFrame:
    """The state after all runs, or after run ``upto``; columns added to the spec since are NULL.

    Rows of the base that no delta mentions pass through unchanged and are not shuffled when the deltas' keys are few
    enough for Spark to broadcast; only the others are compared with what came later.
    """
    _, base, deltas = _parts(spark, table, spec, upto)
    if not deltas:
        return spark.createDataFrame([], state_schema(spec)) if base is None else base
    changes = latest_per_key(spark.read.schema(state_schema(spec)).parquet(*deltas), spec.key)
    if base is None:
        return changes
    keys = changes.select(spec.key)
    compared = latest_per_key(base.join(keys, spec.key, "left_semi").select(*base.columns).unionByName(changes), spec.key)
    return base.join(keys, spec.key, "left_anti").select(*base.columns).unionByName(compared)


def read_mirror(spark: SparkSession, table: str, spec: S.TableSpec, upto: int | None = None) -> DataFrame:
    """Live rows after all runs, or after run ``upto``."""
    return live_rows(read_state(spark, table, spec, upto), spec)


def fold(spark: SparkSession, table: str, spec: S.TableSpec, share: float = 0.1) -> bool:
    """Make a new base if the deltas after the last one have more than ``share`` of its rows; returns whether it did.

    Rows are counted from the files' footers.
    """
    _, base, deltas = _parts(spark, table, spec, None)
    if not deltas:
        return False
    if base is not None and spark.read.parquet(*deltas).count() <= share * base.count():
        return False
    last = max(_finished(spark, f"{table}/deltas", "run"))
    read_state(spark, table, spec).write.parquet(_next_path(spark, f"{table}/bases", "through", last))
    return True


def replace_state(state: DataFrame, table: str, spec: S.TableSpec, run: int) -> None:
    """Make ``state`` the base from which run ``run`` and later ones are read; earlier runs stay as they were."""
    state.select(*state_schema(spec).names).write.parquet(_next_path(state.sparkSession, f"{table}/bases", "through", run))


def return_to(spark: SparkSession, table: str, spec: S.TableSpec, run: int, number: int) -> None:
    """A new run ``number`` that stands where an earlier one stood."""
    replace_state(read_state(spark, table, spec, run), table, spec, number)


def drop_before(spark: SparkSession, table: str, run: int) -> int:
    """Delete what no state from ``run`` on needs, and writes that were never finished; returns how many folders.

    The base to start from at ``run`` stays, and so do the deltas after it.
    """
    bases, deltas = _finished(spark, f"{table}/bases", "through"), _finished(spark, f"{table}/deltas", "run")
    through = max((r for r in bases if r <= run), default=-1)
    keep = {path for r, path in bases.items() if r >= through} | {path for r, path in deltas.items() if r > through}
    gone = 0
    for folder, key in ((f"{table}/bases", "through"), (f"{table}/deltas", "run")):
        for attempts in _attempts(spark, folder, key).values():
            for _, path in attempts:
                gone += path not in keep and remove(spark, path)
    return gone
