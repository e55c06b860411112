"""SimHash near-dedup with pigeonring filtering.

A fingerprint is cut into segments on a ring, one more than the greatest number k of differing bits. If two
fingerprints differ in at most k bits, then some segment begins a chain all of whose prefixes keep to their share: the
first l segments differ in at most l * k / (k + 1) bits, rounded down. The first segment is thus equal and the first
two differ in at most one bit. That is the join key, so fingerprints which agree in one segment only, as many do in a
large group of near copies, never meet. Longer prefixes are checked on the joined rows, the whole distance last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, stored, with_whole_rows
from tidemark.llm.graph import components

BITS = 64
_SEED = 42
_ROWS = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the 64-bit hashes of all shingles, as a signed integer.

    Words are what lies between white space of ASCII, A-Z in lower case. Repeated shingles count as often as they
    occur; fewer words than a shingle has make one shingle, and no words give zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(s, _SEED) for s in joined], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), _ROWS):
        bits = np.unpackbits(values[at:at + _ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(values), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint) per row. NULL and empty texts get zero; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(values, pa.int64())],
                                             names=["doc_id", "fingerprint"])

    texts = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(texts, run, "doc_id bigint, fingerprint bigint")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of ``distance`` + 1 segments."""
    count = distance + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(value, at: tuple[int, int]):
    return F.shiftrightunsigned(value, at[0]).bitwiseAND(F.lit((1 << at[1]) - 1).cast("long"))


def _spread(number: int) -> int:
    """A signed 64-bit value that is far from those of other small numbers."""
    value = number * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def close_pairs(prints: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b) of ids, a < b, whose different fingerprints differ in at most ``distance`` bits.

    ``prints`` has one row (id, fingerprint) per distinct fingerprint. A row is sent once per segment, and once per
    segment and bit of the segment after it to meet fingerprints that differ in that bit.
    """
    ring = segments(distance)
    count = len(ring)
    exact, near = [], []
    for i, first in enumerate(ring):
        value = F.col("fingerprint")
        second = ring[(i + 1) % count]
        # Rows of different segments that get the same key are told apart by the chain below.
        head = F.shiftleft(_part(value, first), second[1]).bitwiseXOR(F.lit(_spread(i)).cast("long"))
        exact.append(head.bitwiseXOR(_part(value, second)))
        tail = _part(value, second)
        near += [head.bitwiseXOR(tail).bitwiseXOR(F.lit(mask).cast("long")) for mask in (0, *(1 << bit for bit in range(second[1])))]
    left = prints.select(F.col("id").alias("a"), F.col("fingerprint").alias("x"),
                         F.posexplode(F.array(*exact)).alias("start", "key"))
    right = prints.select(F.col("id").alias("b"), F.col("fingerprint").alias("y"),
                          F.explode(F.array(*near)).alias("key"))
    differing = F.col("x").bitwiseXOR(F.col("y"))
    chains = F.lit(False)
    for i in range(count):
        within = F.lit(True)
        spent = F.lit(0)
        for length in range(1, count):
            spent = spent + F.bit_count(_part(differing, ring[(i + length - 1) % count]))
            within = within & (spent <= length * distance // count)
        chains = chains | ((F.col("start") == i) & within)
    # Spark sizes exploded rows as if they were as many as before, and would broadcast 69 rows per fingerprint.
    return left.hint("merge").join(right, "key") \
        .filter((F.col("a") < F.col("b")) & chains & (F.bit_count(differing) <= distance)) \
        .select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint, component_id) per row of ``docs``.

    Documents link when their fingerprints differ in at most ``distance`` bits; component_id is the smallest doc_id
    reachable over links. Equal fingerprints are one node, so a group of copies costs one row. Texts without words
    all have fingerprint zero and link like any other. A row without id gets its fingerprint, but no component and
    no part in others'. Repeated rows come back as often as they are given; an empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    nodes = stored(prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "nodes")
    groups = components(close_pairs(nodes, distance)) if distance else None
    if groups is None:
        named = nodes.withColumn("component_id", F.col("id"))
    else:
        named = nodes.join(groups.withColumnRenamed("node", "id"), "id", "left") \
            .withColumn("component_id", F.coalesce("component", "id"))
    named = named.select("fingerprint", "component_id")
    known = prints.filter("doc_id is not null").join(named, "fingerprint") \
        .select("doc_id", "fingerprint", "component_id")
    lost = prints.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    return known.union(lost)


def hexadecimal(value):
    """16 lower-case hex digits of a bigint."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id. Rows without id stay.

    Of rows that share an id, the one with the smallest text stays.
    """
    found = near_duplicates(docs, shingle, distance, doc_id, text)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = with_whole_rows(docs, kept_id=doc_id, text=text).withColumn("kept_id", F.col("kept_id").cast("long"))
    chosen = rows.filter("kept_id is not null").join(kept, "kept_id").withColumn("at", F.expr(
        "row_number() over (partition by kept_id order by text nulls last)")).filter("at = 1")
    return chosen.select("whole.*").union(rows.filter("kept_id is null").select("whole.*")).toDF(*docs.columns)
