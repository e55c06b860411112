"""Removal of byte strings that an earlier document holds already, by suffix arrays built with two-stage sorting.

A string of ``length`` bytes is a window. Windows are dealt to tasks by content: the least hash among the short grams of
a window, its anchor, is the same wherever the window stands, so equal windows meet. An anchor that one document alone
holds has no repeated window, and its text stays where it is; the others send the stretches of text around them, each
distinct stretch once per group of documents (shard). Every task then sorts the suffixes of its stretches in two stages:

1. Suffixes smaller than their successor are sorted directly, as far as a window goes.
2. All others are induced: buckets of first bytes are scanned in order, and the suffix one byte before each scanned one
   is put next in its bucket if it is greater than its successor.

Adjacent suffixes with a common prefix of a window's length are equal windows; the least document id of each run of them
says which occurrences go. Documents are shuffled once; the anchor and span steps use the same shuffle again. Of equal
texts only the one of least id takes part, the others go whole.

An anchor of very many different stretches would bring them all to one task. They are cut into single windows, which are
dealt by their own content. That moves some ten times the bytes, so it is the stretches that count and not the shards: a
passage that stands in every shard has few different ones in each.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, ship

#: Text of about so many bytes makes a shard; stretches of a shard go to so many times as many tasks.
SHARD_BYTES, SPREAD = 8 << 20, 8
#: An anchor of more stretches than this, different ones in each shard, has them cut into windows; at least so many a shard.
WIDE, WIDE_SHARD = 1 << 14, 2
#: Windows in a stretch at most, and bytes looked at in one go.
_STRETCH, _SLICE = 64, 1 << 18
# An anchor travels as the upper bits of its hash; to be compared, it gets the number of its shard in the lower ones.
_SHARD_BITS = 24
_BASE = 0x9E3779B97F4A7C15
_CODE_BITS = 9


def gram_size(length: int) -> int:
    return max(1, 2 * length // 5)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A mixed 64-bit hash of every string of ``size`` bytes, put together from those of powers of two."""
    power, done, width = data.astype(np.uint64) + np.uint64(1), 0, 1
    out, rest = None, size
    while rest:
        if rest & 1:
            if out is None:
                out = power
            else:
                n = len(data) - done - width + 1
                out = out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[done:done + n]
            done += width
        rest >>= 1
        if rest:
            n = len(power) - width
            power = power[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:]
            width *= 2
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    least, n = values, 1
    while 2 * n <= width:
        least, n = np.minimum(least[:len(least) - n], least[n:]), 2 * n
    rest = width - n
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def stretches(data: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of one anchor, at most so many: first window, number of windows, anchor.

    ``data`` holds pieces of text one after the other; no window crosses from one to the next.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64)
    anchors = sliding_min(gram_hashes(data, gram_size(length)), length - gram_size(length) + 1)
    ends = np.cumsum(lengths)
    firsts, counts = ends - lengths, np.maximum(lengths - length + 1, 0)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, firsts[counts > 0], 1)
    np.add.at(inside, (firsts + counts)[counts > 0], -1)
    at = np.flatnonzero(np.cumsum(inside[:len(anchors)], dtype=np.int8))
    if not len(at):
        return none, none, none.astype(np.uint64)
    anchors, starts = anchors[at], np.zeros(len(data), bool)
    starts[firsts[counts > 0]] = True
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | (at[1:] != at[:-1] + 1) | starts[at[1:]]]
    runs = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(runs, np.diff(np.r_[runs, len(at)]))
    cuts = np.flatnonzero(place % _STRETCH == 0)
    return at[cuts], np.diff(np.r_[cuts, len(at)]), anchors[cuts]


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts by the slice: lists of (row, first byte, bytes). Slices of a long text overlap by less than a window."""
    batch, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), _SLICE):
            batch.append((row, start, text[start:start + _SLICE + length - 1]))
            size += len(batch[-1][2])
            if size >= _SLICE:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _found(texts: list[bytes], length: int):
    """Per slice of texts: its bytes, and row, first byte in that text, place, windows and anchor of its stretches."""
    for batch in pieces(texts, length):
        data = b"".join(p[2] for p in batch)
        lengths = np.array([len(p[2]) for p in batch], np.int64)
        first, count, anchor = stretches(np.frombuffer(data, np.uint8), lengths, length)
        starts = np.cumsum(lengths) - lengths
        piece = np.searchsorted(starts, first, side="right") - 1
        # Empty pieces share their start with the next one; the last of equals is the one that holds the window.
        row = np.array([p[0] for p in batch], np.int64)[piece]
        offset = np.array([p[1] for p in batch], np.int64)[piece] + first - starts[piece]
        yield data, row, offset, first, count, anchor


def direct_order(codes: np.ndarray, chosen: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """``chosen`` suffixes in order of their first ``depth`` codes; ``left`` tells how far each one's stretch goes on."""
    words = np.zeros(len(codes) + depth + 8, np.int64)
    words[:len(codes)] = codes
    four = words[:-3].copy()
    for i in (1, 2, 3):
        four = (four << _CODE_BITS) | words[i:len(words) - 3 + i]
    key = (four[chosen] << (3 * _CODE_BITS)) | (four[chosen + 4] >> _CODE_BITS)
    by = np.argsort(key)
    order, key, reached = chosen[by], key[by], 7
    group = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    group = np.repeat(group, np.diff(np.r_[group, len(order)]))
    while reached < depth:
        # What is alone in its group is in place; so is what has run past its end, as then all of its group have.
        open_ = np.flatnonzero(np.r_[group[1:] == group[:-1], False] | np.r_[False, group[1:] == group[:-1]])
        open_ = open_[left[order[open_]] >= reached]
        if not len(open_):
            break
        key = (group[open_] << (4 * _CODE_BITS)) | four[order[open_] + reached]
        by = np.argsort(key)
        order[open_], key = order[open_][by], key[by]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        group[open_] = np.repeat(open_[new], np.diff(np.r_[new, len(open_)]))
        reached += 4
    return order


def suffix_order(codes: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``codes``, in which 0 ends each stretch, in order of their first ``depth`` codes."""
    runs = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    heads = codes[runs]
    smaller = np.repeat(np.r_[heads[:-1] < heads[1:], True], np.diff(np.r_[runs, len(codes)]))
    ends = np.flatnonzero(codes == 0)
    direct = np.flatnonzero(smaller & (codes > 0))
    ordered = direct_order(codes, direct, left, depth) if len(direct) else direct
    top = int(codes.max()) + 1
    bounds = np.searchsorted(codes[ordered], np.arange(top + 1))
    waiting, out = defaultdict(list), []

    def scan(bucket: np.ndarray) -> None:
        before = bucket[bucket > 0] - 1
        before = before[~smaller[before]]
        by = np.argsort(codes[before], kind="stable")
        before = before[by]
        heads = codes[before]
        cuts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]]) if len(heads) else []
        for i, cut in enumerate(cuts):
            waiting[int(heads[cut])].append(before[cut:cuts[i + 1] if i + 1 < len(cuts) else None])

    scan(ends)
    for code in range(1, top):
        # Within a bucket, induced suffixes come first; a scan of them may add more to the same bucket.
        while waiting[code]:
            bucket = np.concatenate(waiting.pop(code))
            out.append(bucket)
            scan(bucket)
        bucket = ordered[bounds[code]:bounds[code + 1]]
        out.append(bucket)
        scan(bucket)
    return np.concatenate([ends, *out])


def common_prefixes(codes: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before, counted up to ``most``; 0 for the first."""
    padded = np.r_[codes, np.zeros(most + 8, codes.dtype)].astype(np.int64)
    seven = padded[:-6].copy()
    for i in range(1, 7):
        seven = (seven << _CODE_BITS) | padded[i:len(padded) - 6 + i]
    common = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    done = 0
    while done + 7 <= most and len(at):
        at = at[seven[order[at] + done] == seven[order[at - 1] + done]]
        done += 7
        common[at] = done
    while done < most and len(at):
        at = at[padded[order[at] + done] == padded[order[at - 1] + done]]
        done += 1
        common[at] = done
    return common


def earliest(texts: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window of the ``texts``, one text after the other: the least id of a text that holds it; and where texts begin."""
    data = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    codes = np.zeros(len(data) + len(texts), np.int16)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    ends = begin + sizes
    filled = np.ones(len(codes), bool)
    filled[ends] = False
    codes[filled] = np.frombuffer(data, np.uint8).astype(np.int16) + 1
    left = ends[owner] - np.arange(len(codes))
    order = suffix_order(codes, left, length)
    order = order[left[order] >= length]
    runs = np.flatnonzero(common_prefixes(codes, order, length) < length)
    least = np.minimum.reduceat(ids[owner[order]], runs) if len(order) else np.zeros(0, np.int64)
    found = np.zeros(len(codes), np.int64)
    found[order] = np.repeat(least, np.diff(np.r_[runs, len(order)]))
    windows = sizes - length + 1
    return found[left >= length], np.cumsum(windows) - windows


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def packed(values: np.ndarray) -> bytes:
    """Sorted numbers as the steps between them, least bytes first, so that the many zero bytes lie together."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(value: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(value, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _joined(table: pa.Table, name: str) -> np.ndarray:
    """Sorted numbers of a column of packed values; NULL holds none."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *[unpacked(v) for v in table.column(name).to_pylist() if v]]))


def _eight(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as a number; zeros follow the end."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    return padded[at[:, None] + np.arange(8)].view(np.uint64).ravel()


def different_stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of the ``texts``, sorted, and how many different stretches each has, told by size and both ends."""
    found = []
    for data, _, _, place, count, anchor in _found(texts, length):
        data = np.frombuffer(data, np.uint8)
        ends = _eight(data, place), _eight(data, place + count + length - 1 - min(8, length))
        mark = (ends[0] * np.uint64(_BASE) ^ ends[1]) * np.uint64(_BASE) + count.astype(np.uint64)
        found.append((anchor, mark))
    anchor, mark = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    by = np.lexsort((mark, anchor))
    anchor, mark = anchor[by], mark[by]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (mark[1:] != mark[:-1])][:len(anchor)]
    return np.unique(anchor[new], return_counts=True)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the ``known``, which are sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _taking_part(table: pa.Table, sent: pa.Table, length: int) -> pa.Table:
    """Rows with an id and a window that are the first of their text.

    Left out here and not by a filter, which would keep the steps from sharing one shuffle.
    """
    table = table.filter(pc.and_(pc.is_valid(table.column("id")), pc.greater_equal(pc.binary_length(table.column("text")), length)))
    first = set(zip(sent.column("id").to_pylist(), sent.column("mark").to_pylist()))
    return table.filter(pa.array([row in first for row in zip(table.column("id").to_pylist(), table.column("mark").to_pylist())], pa.bool_()))


def _grouped(key: np.ndarray, **columns) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The different keys, and per key a list of each column's values, given as arrays or lists with their type."""
    by = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(key[by]) != 0]) if len(by) else by
    offsets = pa.array(np.r_[cuts, len(by)], pa.int32())
    lists = {}
    for name, (values, kind) in columns.items():
        values = [values[i] for i in by.tolist()] if isinstance(values, list) else values[by]
        lists[name] = pa.ListArray.from_arrays(offsets, pa.array(values, kind))
    return key[by][cuts], lists


_SPAN = {"id": pa.int64(), "mark": pa.int64(), "lo": pa.int32(), "hi": pa.int32()}
_SPAN_SCHEMA = "id array<bigint>, mark array<bigint>, lo array<int>, hi array<int>"


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, as one."""
    out = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def first_of_texts(shards: DataFrame) -> DataFrame:
    """(shard, id, mark) of the least id of every distinct text."""
    best = shards.filter(F.col("id").isNotNull()).groupBy(F.sha2("text", 256).alias("digest")) \
        .agg(F.min(F.struct("id", "mark", "shard")).alias("first"))
    return best.select("first.shard", "first.id", "first.mark")


def repeated_anchors(shards: DataFrame, firsts: DataFrame, length: int, slots: int, wide: int = WIDE) -> DataFrame:
    """(shard, repeated, wide): upper bits of the anchors that other shards hold too, and of those of very many stretches."""
    def collect(table: pa.Table, sent: pa.Table) -> pa.Table:
        table = _taking_part(table, sent, length)
        if not len(table):
            return pa.table([pa.array([], k) for k in (pa.int32(), pa.int32(), pa.binary(), pa.binary())],
                            names=["slot", "shard", "anchors", "counts"])
        shard = table.column("shard")[0].as_py()
        known, counts = different_stretches(table.column("text").to_pylist(), length)
        slot = (known % np.uint64(slots)).astype(np.int64)
        by = np.argsort(slot, kind="stable")
        known, counts = known[by] >> np.uint64(_SHARD_BITS), np.minimum(counts[by], 0xFFFF).astype(np.uint16)
        cuts = np.flatnonzero(np.diff(slot[by], prepend=-1))
        return pa.table({"slot": pa.array(slot[by][cuts], pa.int32()), "shard": pa.array(np.full(len(cuts), shard), pa.int32()),
                         "anchors": pa.array([packed(p) for p in np.split(known, cuts[1:])], pa.binary()),
                         "counts": pa.array([c.tobytes() for c in np.split(counts, cuts[1:])], pa.binary())})

    def compare(table: pa.Table) -> pa.Table:
        lists = [unpacked(v) for v in table.column("anchors").to_pylist()]
        shard = np.repeat(_numbers(table, "shard").astype(np.uint64), [len(v) for v in lists])
        both, place = np.unique(np.concatenate(lists) << np.uint64(_SHARD_BITS) | shard, return_inverse=True)
        counts = np.bincount(place, np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint16))
        anchor = both >> np.uint64(_SHARD_BITS)
        shard = (both & np.uint64((1 << _SHARD_BITS) - 1)).astype(np.int64)
        runs = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[runs, len(anchor)])
        broad = np.repeat(np.add.reduceat(counts, runs) > wide, sizes)
        keep = np.repeat(sizes, sizes) > 1
        anchor, shard, broad = anchor[keep], shard[keep], broad[keep]
        by = np.argsort(shard, kind="stable")
        anchor, shard, broad = anchor[by], shard[by], broad[by]
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        parts = [(anchor[a:b], broad[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(anchor)])]
        return pa.table({"shard": pa.array(shard[cuts], pa.int32()), "repeated": pa.array([packed(a) for a, _ in parts], pa.binary()),
                         "wide": pa.array([packed(a[w]) for a, w in parts], pa.binary())})

    sent = shards.groupBy("shard").cogroup(firsts.groupBy("shard")).applyInArrow(
        collect, "slot int, shard int, anchors binary, counts binary")
    return sent.groupBy("slot").applyInArrow(compare, "shard int, repeated binary, wide binary")


def repeated_stretches(shards: DataFrame, firsts: DataFrame, anchors: DataFrame, length: int, tasks: int) -> DataFrame:
    """Stretches around repeated anchors, dealt to ``tasks``; of those that a shard holds more than once, the least id's.

    The others are settled: their spans go along as they are, without the stretch.
    """
    def none() -> pa.Table:
        return pa.table([pa.array([], pa.int32())] * 2 + [pa.array([], pa.list_(k)) for k in (*_SPAN.values(), pa.binary())],
                        names=["task", "shard", *_SPAN, "stretch"])

    def cut(table: pa.Table, sent: pa.Table) -> pa.Table:
        table = _taking_part(table, sent.filter(pc.is_null(sent.column("repeated"))), length)
        if not len(table):
            return none()
        shard = table.column("shard")[0].as_py()
        ids, marks = _numbers(table, "id"), _numbers(table, "mark")
        texts = table.column("text").to_pylist()
        low = np.uint64(_SHARD_BITS)
        # Which of its own anchors several of the shard's rows hold.
        seen = [np.unique((anchor >> low << low) | row.astype(np.uint64)) for _, row, _, _, _, anchor in _found(texts, length)]
        own = np.unique(np.concatenate(seen)) >> low
        own = own[1:][own[1:] == own[:-1]]
        repeated, wide = np.union1d(own, _joined(sent, "repeated")), _joined(sent, "wide")
        rows, los, dealt, parts = [], [], [], []
        for data, row, offset, place, count, anchor in _found(texts, length):
            keep = np.flatnonzero(_among(anchor >> low, repeated))
            broad = _among(anchor[keep] >> low, wide)
            for chosen, single in ((keep[~broad], False), (keep[broad], True)):
                starts, size = place[chosen], count[chosen] + length - 1
                back, step = chosen, np.zeros(len(chosen), np.int64)
                if single:  # every window for itself
                    back = np.repeat(chosen, count[chosen])
                    step = np.arange(len(back)) - np.repeat(np.cumsum(count[chosen]) - count[chosen], count[chosen])
                    starts, size = place[back] + step, np.full(len(back), length)
                found = [data[a:a + n] for a, n in zip(starts.tolist(), size.tolist())]
                parts += found
                rows.append(row[back])
                los.append(offset[back] + step)
                dealt.append(np.array([zlib.crc32(w) % tasks for w in found], np.int64) if single
                             else (anchor[back] % np.uint64(tasks)).astype(np.int64))
        if not parts:
            return none()
        row, lo, task = np.concatenate(rows), np.concatenate(los), np.concatenate(dealt)
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(p, len(number)) for p in parts], np.int64)
        hi = lo + np.array([len(p) for p in parts], np.int64)
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids[row])
        later = ids[row] > least[which]
        sent_on = np.flatnonzero(~later)
        keys, lists = _grouped(task[sent_on], id=(ids[row[sent_on]], pa.int64()), mark=(marks[row[sent_on]], pa.int64()),
                               lo=(lo[sent_on], pa.int32()), hi=(hi[sent_on], pa.int32()),
                               stretch=([parts[i] for i in sent_on.tolist()], pa.binary()))
        out = pa.table([pa.array(keys, pa.int32()), pa.array(np.full(len(keys), shard), pa.int32()), *lists.values()],
                       names=["task", "shard", *lists])
        settled = defaultdict(list)
        for r, a, b in zip(row[later].tolist(), lo[later].tolist(), hi[later].tolist()):
            settled[r].append((a, b))
        spans = [(ids[r], marks[r], a, b) for r, found in settled.items() for a, b in _united(found)]
        if not spans:
            return out
        lists = [pa.array([v], pa.list_(k)) for v, k in zip(zip(*spans), _SPAN.values())]
        known = pa.table([pa.array([shard % tasks], pa.int32()), pa.array([shard], pa.int32()), *lists,
                          pa.array([None], pa.list_(pa.binary()))], names=out.column_names)
        return pa.concat_tables([out, known])

    sent = anchors.select("shard", "repeated", "wide", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("mark")) \
        .unionByName(firsts, allowMissingColumns=True)
    return shards.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(
        cut, f"task int, shard int, {_SPAN_SCHEMA}, stretch array<binary>")


def repeated_spans(sent: DataFrame, length: int) -> DataFrame:
    """Spans covered by windows that a smaller id holds: (shard, id, mark, lo, hi), in lists. By suffix arrays."""
    def sort(table: pa.Table) -> pa.Table:
        table = table.select(["shard", *_SPAN, "stretch"])
        known = pc.is_null(table.column("stretch"))
        settled, open_ = table.filter(known).drop_columns(["stretch"]), table.filter(pc.invert(known)).combine_chunks()
        if not len(open_):
            return settled
        flat = {name: open_.column(name).combine_chunks().flatten() for name in (*_SPAN, "stretch")}
        shard = np.repeat(_numbers(open_, "shard"), pc.list_value_length(open_.column("stretch")).to_numpy())
        ids, marks, lo, hi = (flat[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in _SPAN)
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(p, len(number)) for p in flat["stretch"].to_pylist()], np.int64)
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, which, ids)
        found, begin = earliest(list(number), least, length)
        # Whole stretches of a greater id go; of the least id's, what another stretch has for a smaller one.
        whole = np.flatnonzero(ids > least[which])
        doubtful = np.flatnonzero((ids == least[which]) & (np.minimum.reduceat(found, begin)[which] < ids))
        picked, los, his = [whole], [lo[whole]], [hi[whole]]
        for i in doubtful.tolist():
            at = begin[which[i]]
            gone = found[at:at + hi[i] - lo[i] - length + 1] < ids[i]
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
            picked.append(np.full(len(edges), i))
            los.append(lo[i] + edges[:, 0])
            his.append(lo[i] + edges[:, 1] + length - 1)
        back = np.concatenate(picked)
        keys, lists = _grouped(shard[back], id=(ids[back], pa.int64()), mark=(marks[back], pa.int64()),
                               lo=(np.concatenate(los), pa.int32()), hi=(np.concatenate(his), pa.int32()))
        out = pa.table([pa.array(keys, pa.int32()), *lists.values()], names=["shard", *lists])
        return pa.concat_tables([out, settled.cast(out.schema)])

    return sent.groupBy("task").applyInArrow(sort, f"shard int, {_SPAN_SCHEMA}")


def remove_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text",
                   shard_bytes: int = SHARD_BYTES, wide: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, spans removed (array of lo, hi; end exclusive) and the bytes kept.

    A byte goes if a string of ``length`` bytes over it, within its text, also starts in a text of smaller id. Texts are
    taken as UTF-8, whole, and judged as given; NULL is the empty text. Texts shorter than ``length`` stay as they
    are. A row without id neither loses bytes nor makes others lose any. Rows of equal id do not take from each
    other, repeated rows come back as often as given, and other columns play no part.
    """
    ship(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text).select(F.col("id").cast("long").alias("id"),
                                                   F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    size = max(shard_bytes, -(-total // (1 << _SHARD_BITS)))
    count = max(1, -(-total // size))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("id", "mark"), F.lit(count)).cast("int"))
    firsts = first_of_texts(shards)
    anchors = repeated_anchors(shards, firsts, length, count, max(WIDE, WIDE_SHARD * count) if wide is None else wide)
    spans = repeated_spans(repeated_stretches(shards, firsts, anchors, length, SPREAD * count), length)
    # A row of firsts among the spans has no list of them.
    known = spans.unionByName(firsts.select("shard", *[F.array(F.col(c)).alias(c) for c in ("id", "mark")]), allowMissingColumns=True)

    def strip(table: pa.Table, sent: pa.Table) -> pa.Table:
        found, first = defaultdict(list), set()
        for row in sent.select(list(_SPAN)).to_pylist():
            if row["lo"] is None:
                first.add((row["id"][0], row["mark"][0]))
            else:
                for one, mark, lo, hi in zip(*row.values()):
                    found[one, mark].append((lo, hi))
        ids, marks, texts = (table.column(n).to_pylist() for n in ("id", "mark", "text"))
        united = {key: _united(value) for key, value in found.items()}
        gone = [united.get((i, m), []) if i is None or (i, m) in first or len(t) < length else [(0, len(t))]
                for i, m, t in zip(ids, marks, texts)]
        kept = []
        for value, cuts in zip(texts, gone):
            at = [0, *[edge for cut in cuts for edge in cut], len(value)]
            kept.append(b"".join(value[a:b] for a, b in zip(at[::2], at[1::2])))
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        return pa.table({"id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                         "spans": pa.array([[{"lo": lo, "hi": hi} for lo, hi in cuts] for cuts in gone], span),
                         "kept": pa.array(kept, pa.binary())})

    out = shards.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(
        strip, "id bigint, n_bytes bigint, spans array<struct<lo: int, hi: int>>, kept binary")
    return out.withColumnRenamed("id", doc_id)


def digest(removed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept, of the result of ``remove_repeats``."""
    return removed.select(
        doc_id, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
