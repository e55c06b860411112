"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are cut into blocks. With a weight of w slots out of every ``frame`` slots, block j of a source
(counted from 1) may not start before slot floor((j - 1) / w) and must be done by ceil(j / w): its window. In every slot
the released block with the earliest deadline runs. Weights sum to one, so every block meets its window, and at any
time the blocks a source has had differ from slots times weight by less than one block.

Weights are exact fractions, and the frame is their common denominator, so the schedule repeats after each frame: only
one frame is worked out on the driver, or what a shorter mixture needs of it, and every block finds its slot by a
look-up. Where a source runs out, the others go on with their weights scaled up; there is one such phase per source at
most.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, with_whole_rows

#: Rows in a block.
BLOCK_ROWS = 32
#: Rows of a slice of a source, which are numbered together, and how many slices there are at least.
_NUMBERED_ROWS, _LEAST_SLICES = 100_000, 64
#: Slots of a schedule that is sent to all workers at most; a longer one is joined by shuffle.
_SENT_SLOTS = 100_000
_MOST = (1 << 63) - 1


def fraction(weight) -> Fraction:
    """A weight as it was meant: the float nearest to a third is a third, 0.15 is 3/20."""
    if not isinstance(weight, float):
        return Fraction(weight)
    simple = Fraction(weight).limit_denominator(10_000)
    return simple if float(simple) == weight else Fraction(repr(weight))


def exact_slots(weights: dict) -> tuple[dict, int]:
    """Slots of each source, and of the smallest frame in which these are in proportion to the weights.

    A source of weight zero has none while others are left.
    """
    some = {s: fraction(w) for s, w in weights.items() if w} or {s: Fraction(1) for s in weights}
    below = math.lcm(*(w.denominator for w in some.values()))
    slots = {s: int(w * below) for s, w in some.items()}
    common = math.gcd(*slots.values())
    return {s: n // common for s, n in slots.items()}, sum(slots.values()) // common


def whole_slots(weights: dict, frame: int) -> dict:
    """Slots of each source in a frame: largest remainders, at least one each, ``frame`` in all."""
    if not weights:
        return {}
    if len(weights) > frame:
        raise ValueError(f"{len(weights)} sources need a frame of as many slots")
    total = sum(weights.values())
    ideal = {s: w / total * (frame - len(weights)) for s, w in weights.items()}
    slots = {s: 1 + math.floor(x) for s, x in ideal.items()}
    spare = frame - sum(slots.values())
    for s in sorted(ideal, key=lambda s: (math.floor(ideal[s]) - ideal[s], str(s)))[:spare]:
        slots[s] += 1
    return slots


def frame_schedule(slots: dict, frame: int, left: dict | None = None) -> dict:
    """Slot of each block of one frame, as a list per source: earliest deadline first among the released.

    With ``left``, the blocks that sources have, it ends where a source runs out.
    """
    waiting, ready = [], []
    order = sorted(slots, key=str)
    for number, source in enumerate(order):
        heapq.heappush(waiting, (0, number, 0))
    placed = {source: [] for source in order}
    for slot in range(frame):
        while waiting and waiting[0][0] <= slot:
            _, number, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * frame // slots[order[number]]), number, block))
        deadline, number, block = heapq.heappop(ready)
        assert slot < deadline, "weights that sum to one can always be scheduled"
        source = order[number]
        placed[source].append(slot)
        if left is not None and block + 1 == left[source]:
            break
        if block + 1 < slots[source]:
            heapq.heappush(waiting, ((block + 1) * frame // slots[source], number, block + 1))
    return placed


def phases(blocks: dict, weights: dict, frame: int | None = None) -> list[dict]:
    """Stretches of the schedule between which a source runs out.

    Each has ``begin`` (its first slot), ``frame`` (slots after which it repeats), ``slots`` (per source), ``placed``
    (see ``frame_schedule``) and ``done`` (blocks that each source had before).
    """
    left, done, begin, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        own = {s: weights[s] for s in left}
        slots, size = exact_slots(own) if frame is None else (whole_slots(own, frame), frame)
        placed = frame_schedule(slots, size, left)
        # A schedule that ends within its first frame has placed all blocks of a source.
        length = min((n - 1) // slots[s] * size + placed[s][(n - 1) % slots[s]] + 1
                     for s, n in left.items() if s in slots and len(placed[s]) == min(n, slots[s]))
        out.append({"begin": begin, "frame": size, "slots": slots, "placed": placed, "done": dict(done)})
        for s in slots:
            whole, rest = divmod(length, size)
            had = whole * slots[s] + sum(1 for at in placed[s] if at < rest)
            done[s] += had
            left[s] -= had
            if not left[s]:
                del left[s]
        begin += length
    return out


def numbered(rows: DataFrame, source: str, key: str) -> DataFrame:
    """``rows`` with ``at``: a number from 0 without gaps within each source, in an order set by the hash of ``key``.

    A source may hold any share of the rows: it is split into slices by that hash, rows are numbered within a slice
    and slices follow each other.
    """
    total = rows.count()
    slices = max(_LEAST_SLICES, min(1 << 20, total // _NUMBERED_ROWS + 1))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(slices)))
    counts = sliced.groupBy(source, "slice").agg(F.count("*").alias("rows"))
    first = counts.withColumn("first", F.expr(
        f"coalesce(sum(rows) over (partition by `{source}` order by slice rows between unbounded preceding "
        "and 1 preceding), 0)")).drop("rows")
    inner = sliced.withColumn("inner", F.expr(
        f"row_number() over (partition by `{source}`, slice order by xxhash64(`{key}`, 1), `{key}`) - 1"))
    return inner.join(first, [source, "slice"]).withColumn("at", F.col("first") + F.col("inner")) \
        .drop("slice", "first", "inner")


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS, frame: int | None = None,
        doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Place of every row in the mixture: doc_id, source, block, released, deadline, slot, position.

    ``weights``: target weight by source; sources that are not named, and all if it is None, share what is left of 1
    in equal parts, or get the smallest named weight if nothing is left. A source of weight zero comes after the others. NULL is a source
    of its own, shown as NULL. ``frame``: round weights to multiples of 1 / frame, at least one each; as it is, weights
    are exact. ``block`` counts a source's blocks, ``slot`` is the place of the block in the mixture, ``position`` orders rows (slot, then row in block) and
    has gaps only where a source's last block is short. released <= slot < deadline. Every row is placed exactly once,
    repeated rows too; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    name = F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    named = pick(docs, doc_id=doc_id, source=source).withColumn("named", name)
    rows = numbered(named, "named", "doc_id")
    counts = {r["named"]: r["rows"] for r in named.groupBy("named")
              .agg(F.count("*").alias("rows")).collect()}  # a row per source
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    given = {f"={s}" if s is not None else "null": fraction(w) for s, w in (weights or {}).items()}
    if any(w < 0 for w in given.values()):
        raise ValueError("weights cannot be negative")
    others = [s for s in blocks if s not in given]
    spare = max(Fraction(0), 1 - sum(given.values())) / max(1, len(others))
    spare = spare or min([w for w in given.values() if w > 0], default=Fraction(1))
    plan = phases(blocks, {s: given.get(s, spare) for s in blocks}, frame)
    table, spans = [], []
    for number, phase in enumerate(plan):
        later = plan[number + 1]["done"] if number + 1 < len(plan) else blocks
        size = phase["frame"]
        for s, slots in phase["slots"].items():
            # Only a frame that repeats is longer in blocks than what is placed of it.
            repeats = len(phase["placed"][s]) == slots and size <= _MOST
            spans.append((s, number, phase["begin"], phase["done"][s], later[s], slots if repeats else _MOST,
                          size if repeats else 0))
            table += [(number, s, i, i * size // slots, min(-(-(i + 1) * size // slots), _MOST >> 1), at)
                      for i, at in enumerate(phase["placed"][s])]
    small = len(table) <= _SENT_SLOTS
    spans = spark.createDataFrame(spans, "named string, phase int, begin long, first long, until long, slots long, "
                                         "frame long")
    table = spark.createDataFrame(table, "phase int, named string, nth long, opens long, closes long, offset long")
    placed = rows.withColumn("block", F.floor(F.col("at") / block_rows).cast("long"))
    # Spans are bounded by sources. The table has the slots of a frame per phase, whatever the number of rows, unless
    # weights with long fractions make the frame longer than the phase: then it has as many as the phase.
    placed = placed.join(F.broadcast(spans), (placed["named"] == spans["named"]) & (F.col("block") >= F.col("first"))
                         & (F.col("block") < F.col("until"))).drop(spans["named"])
    placed = placed.withColumn("turn", F.expr("(block - first) div slots")) \
        .withColumn("nth", (F.col("block") - F.col("first")) % F.col("slots")) \
        .join(F.broadcast(table) if small else table, ["phase", "named", "nth"])
    start = F.col("begin") + F.col("turn") * F.col("frame")
    slot = start + F.col("offset")
    return placed.select(
        "doc_id", "source", "block", (start + F.col("opens")).alias("released"),
        (start + F.col("closes")).alias("deadline"), slot.alias("slot"),
        (slot * block_rows + F.col("at") % block_rows).cast("long").alias("position"))


def mixed(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS, frame: int | None = None,
          doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` in mixture order: the rows of partition i come before those of partition i + 1. All rows and columns stay.

    Rows that share an id come as often as they were given. Rows without id come last.
    """
    rows = with_whole_rows(docs, mixed_id=doc_id, source=source)
    places = mix(rows.filter("mixed_id is not null"), weights, block_rows, frame, "mixed_id", "source")
    places = places.groupBy("doc_id").agg(F.min("position").alias("position")) \
        .withColumnsRenamed({"doc_id": "mixed_id", "position": "mixed_at"})
    return rows.join(places, "mixed_id", "left").repartitionByRange(F.col("mixed_at").asc_nulls_last()) \
        .sortWithinPartitions(F.col("mixed_at").asc_nulls_last(), "mixed_id").select("whole.*") \
        .toDF(*docs.columns)
