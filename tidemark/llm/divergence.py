"""How much the sources of a language differ in their terms, from a tree of shared term rows.

Per language, a term is a row: which sources have it, and how often. Rows list their sources in one order, so rows that
begin alike share a path of a frequent-pattern tree, and every node knows how many rows run through it. The distance of
two sources is a sum over all terms that starts from what it would be if neither had any term, and is corrected for
terms that one of them has, and for terms that both have. The latter corrections depend on a node and one of its
ancestors only and are added once per such combination, times the node's rows.

Rows are sorted across tasks, so that a task's rows share their beginnings; a task keeps the path it stands on and adds a
node's share when it leaves the node. All numbers are integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, stored

#: Shares are counted in billionths, and each count is raised by so much.
SCALE, RAISE = 1_000_000_000, 5
# Bytes of a term stay, capitals A-Z made small; all others become spaces.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Bytes of text split at once, entries a task holds before it sends them on, and cells of sums likewise.
_SLICE, _ENTRIES, _CELLS = 4 << 20, 300_000, 1 << 22


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    plain = text.translate(_BYTES)
    at = 0
    while at < len(plain):
        end = len(plain) if len(plain) - at <= _SLICE else plain.find(b" ", at + _SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and documents that have the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0

        def emit() -> pa.RecordBatch:
            rows = [(*group, term, n, holders[group][term]) for group, found in counts.items() for term, n in found.items()]
            kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                              names=["lang", "source", "term", "count", "docs"])

        for batch in batches:
            texts = column(batch, "text").to_pylist()
            for lang, source, text in zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist(), texts):
                group, own = (lang, source), set()
                before = len(counts[group])
                for terms in terms_of(text):
                    counts[group].update(terms)
                    own.update(terms)
                holders[group].update(own)
                held += len(counts[group]) - before
                if held >= _ENTRIES:
                    yield emit()
                    counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0
        yield emit()

    sent = map_batches(docs.select("lang", "source", F.col("text").cast("binary").alias("text")), run,
                       "lang string, source string, term binary, count bigint, docs bigint")
    return sent.groupBy("lang", "source", F.col("term").cast("string").alias("term")) \
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str | Column, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + RAISE) / (total + RAISE * terms)), exact beyond the range of a long on the way."""
    wide = "decimal(19,0)"
    over = (F.col(count) if isinstance(count, str) else count).cast(wide) + F.lit(Decimal(RAISE))
    under = F.col(total).cast(wide) + F.lit(Decimal(RAISE)) * F.col(terms).cast(wide)
    scaled = (over * F.lit(Decimal(SCALE))).cast("decimal(38,0)")
    under = F.nullif(under.cast("decimal(38,0)"), F.lit(Decimal(0)).cast("decimal(38,0)"))
    return (F.lit(1) + ((scaled - scaled % under) / under).cast("bigint")).cast("bigint")


def both_present(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): sums over terms that a and b both have, from rows (lang, row, times), a before b.

    A row's items are (source, p, z): the source's share with the term and without. The value of a node b under an
    ancestor a is |pa - pb| - |pa - zb| - |za - pb| + |za - zb|: less twice what [za, pa] and [zb, pb] have in common.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, path, weight, names = None, [], [], {}
        p, z, place = (np.zeros(16, np.int64) for _ in range(3))
        sums: dict[int, np.ndarray] = {}

        def emit() -> pa.RecordBatch:
            shown = list(names)
            found = [(lang, shown[a], shown[b], int(sums[b][a])) for b in sums for a in np.flatnonzero(sums[b])]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*found) if found else [[]] * 4, kinds)],
                                              names=["lang", "a", "b", "value"])

        def leave(depth: int) -> None:
            while len(path) > depth:
                k, times = len(path) - 1, weight.pop()
                path.pop()
                if k:
                    weight[-1] += times
                    common = np.minimum(p[:k], p[k]) - np.maximum(z[:k], z[k])
                    cells = sums.get(int(place[k]))
                    if cells is None or len(cells) < len(names):
                        cells = np.r_[np.zeros(0, np.int64) if cells is None else cells, np.zeros(2 * len(names), np.int64)]
                        sums[int(place[k])] = cells
                    cells[place[:k]] -= 2 * times * np.maximum(common, 0)  # the sources of a path are all different

        for batch in batches:
            for name, row, times in zip(*(column(batch, c).to_pylist() for c in ("lang", "row", "times"))):
                items = [(i["source"], i["p"], i["z"]) for i in row]
                same = 0
                if name == lang:
                    while same < min(len(path), len(items)) and path[same] == items[same]:
                        same += 1
                leave(same)
                if name != lang or sum(map(len, sums.values())) > _CELLS:
                    if sums:
                        yield emit()
                    if name != lang:
                        lang, names = name, {}
                if len(items) > len(p):
                    p, z, place = (np.r_[old, np.zeros(len(items), np.int64)] for old in (p, z, place))
                for k in range(same, len(items)):
                    path.append(items[k])
                    weight.append(0)
                    p[k], z[k], place[k] = items[k][1], items[k][2], names.setdefault(items[k][0], len(names))
                weight[-1] += times
        leave(0)
        if sums:
            yield emit()

    found = map_batches(rows.select("lang", "row", "times"), run, "lang string, a string, b string, value bigint")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def one_present(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): sums over the terms that a has of |pa - zb| - |za - zb|, whether or not b has them.

    The sum over all shares of a, on either side of zb, follows from how many lie below zb and their sum, which a
    running total in the order of the shares tells.
    """
    shares = cells.groupBy("lang", F.col("source").alias("a"), F.col("p").alias("at")).agg(F.count("*").alias("n"))
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("z").alias(f"z{s}")) for s in "ab")
    asked = a.join(b, "lang").filter("a <> b and za is not null")
    both = shares.select("lang", "a", "at", "n", F.lit(None).cast("string").alias("b"), F.lit(None).cast("bigint").alias("za")) \
        .unionByName(asked.select("lang", "a", F.col("zb").alias("at"), F.lit(0).cast("bigint").alias("n"), "b", "za"))
    group = Window.partitionBy("lang", "a")
    below = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    mass = F.col("n") * F.col("at")
    summed = both.select("lang", "a", "b", "at", "za", F.sum("n").over(group).alias("all_n"), F.sum(mass).over(group).alias("all_p"),
                         F.sum("n").over(below).alias("low_n"), F.sum(mass).over(below).alias("low_p")).filter("b is not null")
    apart = (F.col("all_p") - 2 * F.col("low_p")) - F.col("at") * (F.col("all_n") - 2 * F.col("low_n"))
    return summed.select("lang", "a", "b", (apart - F.col("all_n") * F.abs(F.col("za") - F.col("at"))).alias("value"))


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring pair of language and source.

    Terms are runs of letters A-Z, made small, and of all characters beyond ASCII. A language keeps those of at least
    ``least_docs`` of its documents. A term's share in a group is 1 + floor(10^9 (count + 5) / (N + 5 V)), with N the
    group's occurrences of kept terms and V their number. Part ``pair``: the other sources of the language, by the sum
    over all kept terms of the difference of shares. Part ``term``: the group's terms with a greater share than in the
    language as a whole, by that difference, the first ``top``. Ranks run by value downwards, then by item.

    NULL text, language and source are empty strings; groups without terms count all the same, and a language without
    kept terms has distances of zero. Repeated rows are documents of their own, other columns play no part, and texts of
    any length are read whole. An empty table gives no rows.
    """
    rows = pick(docs, text=text, lang=lang, source=source).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = stored(term_counts(rows), "terms")
    known = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("everywhere")) \
        .filter(F.col("docs") >= least_docs).drop("docs")
    kept = stored(counts.join(known, ["lang", "term"]).select("lang", "source", "term", "count", "everywhere"), "kept")
    langs = kept.select("lang", "term", "everywhere").distinct().groupBy("lang") \
        .agg(F.count("*").alias("terms"), F.sum("everywhere").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left") \
        .select("lang", "source", "lang_total", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "terms")]) \
        .withColumn("z", share(F.lit(0), "total", "terms"))
    groups = stored(groups, "groups")
    cells = kept.join(groups, ["lang", "source"]) \
        .select("lang", "source", "term", share("count", "total", "terms").alias("p"), "z",
                share("everywhere", "lang_total", "terms").alias("q"))
    paths = cells.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "z"))).alias("row")) \
        .groupBy("lang", "row").agg(F.count("*").alias("times"))
    # Rows go to tasks by their first shares: the driver sees a sample of these, and whole rows would be many times larger.
    ahead = [F.get("row", F.lit(i)).getField("p") for i in range(4)]
    paths = paths.repartitionByRange("lang", *ahead, F.xxhash64("row"))
    shared = both_present(paths.sortWithinPartitions("lang", "row"))
    single = one_present(cells, groups)
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("z").alias(f"z{s}"), F.col("terms").alias(f"v{s}")) for s in "ab")
    start = a.join(b, "lang").filter("a <> b") \
        .select("lang", "a", "b", F.coalesce(F.col("va") * F.abs(F.col("za") - F.col("zb")), F.lit(0)).alias("value"))
    one_way = [start, single, shared]
    turned = [df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for df in (single, shared)]
    summed = one_way[0]
    for df in (*one_way[1:], *turned):
        summed = summed.unionByName(df)
    pairs = summed.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value")) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    return pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).filter(F.col("rank") <= top))
