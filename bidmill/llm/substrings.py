"""Repeated substrings: bytes covered by a string of LENGTH bytes that also starts elsewhere.

Every window of LENGTH bytes picks an anchor: its piece of PIECE bytes with the least hash. Equal windows
pick equal anchors, so only the surroundings of anchors that occur more than once can repeat; the
rest of the text, most of it, is settled by counting hashes. Surroundings that occur more than once repeat as a
whole. Where an anchor has different surroundings, these meet, and of their windows those that may be equal are put
into suffix order. There, windows with a common prefix of LENGTH are neighbours; the
previous and the next smaller position in this order tell whether an earlier match of at least LENGTH
exists (a longest previous factor, cut off at LENGTH), and neighbours whether any other does.

All windows around an anchor hold its piece, so those that repeat cover one run of bytes, from the first to the
last of them; only these two need be put into suffix order. Which they may be is told by hashes: first of what
some windows in a row have in common (their core), then of the windows of cores that are seen again.

An anchor with more than MOST different surroundings, such as a line that many documents share, is
not gathered in one task: its surroundings are settled in the same way with longer pieces, which fewer of them
share, and at last with pieces of LENGTH bytes, whose surroundings are all alike.

Each step is written out before the next and lets go of its shuffled files, so the disk holds those of one step. Where
nearly all surroundings differ, they are several times the texts and meet in turns.

Removal is judged on the input. With keep_first the earliest copy, by id and place, stays; without it
all copies go.

Defined cases: null text is no bytes. Matches never cross documents. Rows that repeat an id and its
text are different documents that repeat each other. Null ids come after others, by a hash of the text.
Texts of any length are taken whole, in overlapping pieces.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import byte_powers, letting_go, mixed, span_hashes, stored

LENGTH = 200
PIECE = 48
MOST = 1000
_CHUNK = 1 << 15
_BYTES = 1 << 20
_ROWS = 2048
#: Bytes of surroundings that are shuffled at once, to bytes of the texts.
_SHARE = 1.0


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over each `width` values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(hashes: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Places of hashes that are the least of a valid window of `width` of them; valid: by start of window."""
    least = _sliding(hashes, width, np.minimum)
    least = np.where(valid, least, np.uint64(0))
    # A piece is picked if the least of some window around it is its own hash.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)


def _anchored(data: np.ndarray, ends: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """(place, anchor hash, hash of its surroundings, begin and end of these) as arrays, for texts that end at `ends` of the data."""
    values, up, down = byte_powers()
    width = length - piece + 1
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    found = []
    for at in range(0, len(data) - length + 1, _CHUNK):
        stop = min(at + _CHUNK, len(data) - length + 1)
        texts = slice(*(np.searchsorted(ends, (at, stop - 1), "right") + (0, 1)))
        last = np.repeat(ends[texts] - length, np.diff(np.minimum(ends[texts], stop), prepend=at))
        valid = np.arange(at, stop) <= last
        if not valid.any():
            continue
        pieces = len(valid) + width - 1  # pieces of these windows
        base = max(0, at - width + 1)
        part = data[base : at + pieces + length]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * down[: len(part)], out=sums[1:])
        skip = at - base
        hashes = mixed((sums[skip + piece : skip + piece + pieces] - sums[skip : skip + pieces]) * up[skip : skip + pieces]) | np.uint64(1)
        where = anchors(hashes, valid, width)
        place = where + at
        text = np.searchsorted(ends, place, "right")
        low = np.maximum(place - (width - 1), begins[text])
        high = np.minimum(place + length, ends[text])
        around = mixed((sums[high - base] - sums[low - base]) * up[low - base] + (high - low).astype(np.uint64))
        found.append((place, hashes[where], mixed(around ^ (place - low).astype(np.uint64)), low, high))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing.astype(np.uint64), nothing.astype(np.uint64), nothing, nothing
    found = [np.concatenate(x) for x in zip(*found, strict=True)]
    once = np.unique(found[0], return_index=True)[1]  # chunks overlap
    return tuple(x[once] for x in found)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each ends; null text is no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, ends[1:] - ends[0]


def _slices(batch: pa.RecordBatch, text: int):
    """Parts of a batch with about _BYTES of text each, or one row."""
    ends, at = _bytes_of(batch.column(text))[1], 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _anchor_hashes(parts: DataFrame, length: int, piece: int) -> DataFrame:
    """(anchor) of each place of parts (text)."""

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 0):
                yield pa.RecordBatch.from_arrays([pa.array(_anchored(*_bytes_of(batch.column(0)), length, piece)[1].view(np.int64))], ["anchor"])

    return parts.mapInArrow(run, "anchor long")


def _places(parts: DataFrame, length: int, piece: int) -> DataFrame:
    """(key, mark, p, fit, anchor, around) of parts (key, mark, at, text); fit: bytes of the surroundings before p and behind."""

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 3):
                data, ends = _bytes_of(batch.column(3))
                place, hashes, around, low, high = _anchored(data, ends, length, piece)
                owner = np.searchsorted(ends, place, "right")
                taken = pa.array(owner)
                p = place - np.concatenate([[0], ends])[owner] + batch.column(2).to_numpy()[owner]
                arrays = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(p.astype(np.int32)), pa.array((place - low << 32) + high - place)]
                arrays += [pa.array(hashes.view(np.int64)), pa.array(around.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "mark", "p", "fit", "anchor", "around"])

    return parts.mapInArrow(run, "key long, mark long, p int, fit long, anchor long, around long")


def _asked(parts: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """Parts (key, mark, at, text) with what is asked of their documents: lists of (low, high) and the columns."""
    before, behind = F.shiftright("fit", 32).cast("int"), F.col("fit").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    each = F.struct((F.col("first.p") - before).alias("low"), (F.col("first.p") + behind).alias("high"), *columns)
    lists = wanted.groupBy(F.col("first.key").alias("_k"), F.col("first.mark").alias("_m")).agg(F.collect_list(each).alias("asked"))
    met = parts.join(lists, (F.col("key") == F.col("_k")) & (F.col("mark") == F.col("_m")))
    return met.select("key", "mark", "at", "text", "asked")


def _in_parts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(data, owner, begin and end in the data, which of the asked) of what is asked and lies in the part, for a batch of _asked."""
    data, ends = _bytes_of(batch.column(3))
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(batch.num_rows), batch.column(4).value_lengths().to_numpy())
    offset = (begins - batch.column(2).to_numpy())[owner]
    low, high = (c.to_numpy() + offset for c in batch.column(4).flatten().flatten()[:2])
    which = np.flatnonzero((low >= begins[owner]) & (high <= ends[owner]))
    return data, owner[which], low[which], high[which], which


def _cut(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """data[low:high] for each pair."""
    cuts = np.concatenate([[0], np.cumsum(high - low)]).astype(np.int64)
    taken = data[np.repeat(low - cuts[:-1], high - low) + np.arange(cuts[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(low), [None, pa.py_buffer(cuts), pa.py_buffer(taken)]).cast(pa.binary())


def _surroundings(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, around, key, mark, low, inside, open, bytes) for the first place of each different surroundings.

    Documents that repeat id and text give their rows more than once.
    """

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 3):
                data, owner, low, high, which = _in_parts(batch)
                lists = batch.column(4).flatten().flatten()
                for at in range(0, len(which), 8 * _ROWS):  # a long text may have very many
                    some = slice(at, at + 8 * _ROWS)
                    rows, asked = pa.array(owner[some]), [c.take(pa.array(which[some])) for c in lists]
                    arrays = [asked[2], asked[3], batch.column(0).take(rows), batch.column(1).take(rows), asked[0], asked[4], asked[5], _cut(data, low[some], high[some])]
                    yield pa.RecordBatch.from_arrays(arrays, ["anchor", "around", "key", "mark", "low", "inside", "open", "bytes"])

    met = _asked(parts, wanted.withColumn("inside", F.shiftright("fit", 32).cast("int")), "anchor", "around", "inside", "open")
    return met.mapInArrow(run, "anchor long, around long, key long, mark long, low int, inside int, open boolean, bytes binary")


def _regions(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Parts (key, mark, at, text) of all that surrounds the first places, each byte of a document once."""

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 3):
                data, owner, low, high, _ = _in_parts(batch)
                owner, low, high = _merged(owner, low, high)
                begins = np.concatenate([[0], _bytes_of(batch.column(3))[1]])
                rows = pa.array(owner)
                at = pa.array((low - begins[owner] + batch.column(2).to_numpy()[owner]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), at, _cut(data, low, high)], ["key", "mark", "at", "text"])

    return _asked(parts, wanted).mapInArrow(run, "key long, mark long, at int, text binary")


def _cores(places: np.ndarray, sizes: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """(row, number, first, last) of the groups of windows in a row that the surroundings are cut into.

    places: of the anchor in its surroundings; sizes: of the surroundings. first and last: windows of the
    group that are there. All groups of one number have their windows at the same places from the anchor.
    """
    wide = _wide(length, piece)
    count = -(-(length - piece + 1) // wide)
    row, number = np.repeat(np.arange(len(places)), count), np.tile(np.arange(count), len(places))
    last = places[row] - number * wide
    first = np.maximum(np.maximum(last - wide + 1, 0), places[row] - (length - piece))
    last = np.minimum(last, sizes[row] - length)
    there = first <= last
    return row[there], number[there], first[there], last[there]


def _wide(length: int, piece: int) -> int:
    """Windows of a group: the root of all, for the fewest groups and windows of one group together."""
    return int(np.ceil(np.sqrt(length - piece + 1)))


def _core_spans(places: np.ndarray, number: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """What all windows of a group have in common: where it begins, and its end."""
    wide = _wide(length, piece)
    begin = places - number * wide
    return begin, np.maximum(begin - wide + 1, places - (length - piece)) + length


def _hashes_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes for spans in any order."""
    order = np.argsort(starts, kind="stable")
    out = np.empty(len(starts), np.uint64)
    out[order] = span_hashes(data, starts[order], ends[order])
    return out


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal hashes together, and where each group begins in it."""
    order = np.argsort(hashes, kind="stable")
    if not len(order):
        return order, order
    return order, np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))


def matched(
    data: np.ndarray, ends: np.ndarray, anchor: np.ndarray, docs: np.ndarray, starts: np.ndarray, inside: np.ndarray, open_: np.ndarray, length: int, piece: int, earlier: bool
) -> tuple[np.ndarray, np.ndarray]:
    """For each of different surroundings of anchors: its first and last window that occurs at another place, or at an earlier one.

    ends: of each in the data; docs and starts: where each stands; inside: where its anchor is in it. A window's place is
    only compared with others. The first is -1 where no window does, and where the surroundings are not open.
    """
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    sizes = ends - begins
    seed = mixed(anchor.view(np.uint64))
    # Groups of windows whose core is seen at two places of their anchor, one of them in open surroundings.
    row, number, first, last = _cores(inside, sizes, length, piece)
    begin, end = _core_spans(inside[row], number, length, piece)
    cores = mixed(_hashes_at(data, begins[row] + begin, begins[row] + end) ^ (seed[row] + number.astype(np.uint64)))
    order, at = _groups(cores)
    some = _seen_again(order, at, open_[row])
    row, first, last = row[some], first[some], last[some]
    # Their windows.
    counts = last - first + 1
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    row, window = np.repeat(row, counts), np.repeat(first, counts) + inner
    hashes = mixed(_hashes_at(data, begins[row] + window, begins[row] + window + length) ^ (seed[row] + (inside[row] - window).astype(np.uint64)))
    order, at = _groups(hashes)
    again = _seen_again(order, at, open_[row])
    row, window, hashes = row[again], window[again], hashes[again]
    low, high = np.full(len(ends), -1, np.int64), np.full(len(ends), -1, np.int64)
    if not len(row):
        return low, high
    ranks = np.empty(len(ends), np.int64)
    ranks[np.lexsort((starts + inside, docs))] = np.arange(len(ends))
    order = np.lexsort((ranks[row], hashes))
    at = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    # Within a group of equal hashes: the least two places, and all others.
    group = np.empty(len(row), np.int64)
    group[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    least, second = order[at], order[at + 1]
    may = open_[row] if not earlier else open_[row] & (np.arange(len(row)) != least[group])
    edges = _edges(row, window, may, len(ends))
    asking = np.concatenate(edges)
    asking = asking[asking >= 0]
    chosen = np.unique(np.concatenate([asking, least[group[asking]], second[group[asking]]]))
    position = (docs[row] << 32) + starts[row] + window
    good = np.zeros(len(row), bool)
    good[chosen] = _in_order(data, begins[row[chosen]] + window[chosen], position[chosen], length, earlier)
    if not good[asking].all():  # equal hashes of different windows: all of them decide
        good = _in_order(data, begins[row] + window, position, length, earlier)
        edges = _edges(row, window, may & good, len(ends))
    for out, edge in zip((low, high), edges, strict=True):
        out[edge >= 0] = window[edge[edge >= 0]]
    return low, high


def _seen_again(order: np.ndarray, at: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Members of groups of several, of which one is open, as they stood."""
    if not len(order):
        return order
    sizes = np.diff(np.append(at, len(order)))
    return np.sort(order[np.repeat((sizes > 1) & np.logical_or.reduceat(open_[order], at), sizes)])


def _edges(row: np.ndarray, window: np.ndarray, may: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, which of its windows that may is the first and the last, or -1."""
    which = np.flatnonzero(may)
    which = which[np.lexsort((window[which], row[which]))]
    first, last = np.full(rows, -1, np.int64), np.full(rows, -1, np.int64)
    first[row[which][::-1]] = which[::-1]
    last[row[which]] = which
    return first, last


def _in_order(data: np.ndarray, first: np.ndarray, position: np.ndarray, length: int, earlier: bool) -> np.ndarray:
    """Which windows occur at another place, or at an earlier one, by suffix order; first: where in the data."""
    position = np.unique(position, return_inverse=True)[1]
    windows = np.lib.stride_tricks.sliding_window_view(data, length)[first]
    suffixes = np.argsort(windows.view(f"S{length}").ravel(), kind="stable")
    ordered = windows[suffixes]
    new = np.ones(len(suffixes), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)  # common prefix with the last one under `length`
    run, where = np.cumsum(new) - 1, position[suffixes]
    # The least and greatest position before and behind each place, within a run of common prefixes.
    least, most = [_nearest(where, run), _nearest(where[::-1], _back(run))[::-1]], [-_nearest(-where, run), -_nearest(-where[::-1], _back(run))[::-1]]
    out = np.zeros(len(first), bool)
    out[suffixes] = (least[0] < where) | (least[1] < where)
    if not earlier:
        out[suffixes] |= (most[0] > where) | (most[1] > where)
    return out


def _back(run: np.ndarray) -> np.ndarray:
    return run[-1] - run[::-1] if len(run) else run


def _nearest(where: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The least value from the beginning of each place's run up to it."""
    span = 2 * len(where) + 2
    return np.minimum.accumulate(where - run * span) + run * span


_SPANS = "key long, mark long, low int, high int"


def _in_suffix_order(rows: DataFrame, length: int, piece: int, earlier: bool) -> DataFrame:
    """(key, mark, low, high): the run of bytes that repeats in each of the surroundings, all rows of an anchor together."""

    def run(batches):
        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                anchor = batch.column(0).to_numpy()
                ahead = held[-1].column(0)[-1].as_py() if held else None
                new = np.flatnonzero(np.concatenate([[ahead is not None and anchor[0] != ahead], anchor[1:] != anchor[:-1]]))
                cut = int(new[-1]) if len(new) else 0  # the last anchor may go on
                if len(new) and size + cut >= _ROWS:
                    yield judged(held + [batch.slice(0, cut)])
                    held, size, batch = [], 0, batch.slice(cut)
                held.append(batch)
                size += batch.num_rows
        if held:
            yield judged(held)

    def judged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks()
        anchor, around = table["anchor"].to_numpy(), table["around"].to_numpy()
        once = np.ones(len(anchor), bool)  # documents that repeat id and text give rows again
        once[1:] = (anchor[1:] != anchor[:-1]) | (around[1:] != around[:-1])
        table = table.filter(pa.array(once)).combine_chunks()
        key, mark, starts, inside = (table[n].to_numpy() for n in ("key", "mark", "low", "inside"))
        order = np.lexsort((mark, key))
        new = np.zeros(len(order), np.int64)
        new[1:] = (key[order][1:] != key[order][:-1]) | (mark[order][1:] != mark[order][:-1])
        docs = np.empty(len(order), np.int64)
        docs[order] = np.cumsum(new)
        data, ends = _bytes_of(table["bytes"].chunk(0))
        low, high = matched(data, ends, table["anchor"].to_numpy(), docs, starts.astype(np.int64), inside.astype(np.int64), table["open"].to_numpy(), length, piece, earlier)
        hit = np.flatnonzero(low >= 0)
        arrays = [pa.array(key[hit]), pa.array(mark[hit]), pa.array((starts[hit] + low[hit]).astype(np.int32)), pa.array((starts[hit] + high[hit] + length).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, ["key", "mark", "low", "high"])

    grouped = rows.repartition(F.col("anchor")).sortWithinPartitions("anchor", "around")
    return grouped.mapInArrow(run, _SPANS)


def _longer(length: int, piece: int) -> int:
    """The piece to settle crowded anchors with: it halves the windows around it, then quarters them, and takes few of them one by one."""
    rest = length - piece
    return length - (rest // 2 if 2 * rest > length else rest // 4 if rest > 32 else 0)


def _in_turns(parts: DataFrame, kinds: DataFrame, each: int) -> list[DataFrame]:
    """Kinds, of up to `each` bytes, by their anchors in turns: at once their bytes are at most _SHARE of all that is looked at."""
    with letting_go(parts.sparkSession):
        whole = parts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        turns = max(1, ceil(kinds.count() * each / max(1, whole * _SHARE)))
    return [kinds.where(F.pmod(F.xxhash64("anchor"), F.lit(turns)) == i) for i in range(turns)] if turns > 1 else [kinds]


def _repeats(parts: DataFrame, length: int, piece: int, keep_first: bool) -> list[DataFrame]:
    """Frames of (key, mark, low, high): bytes to remove of documents of which parts (key, mark, at, text) are looked at."""
    spark = parts.sparkSession
    shared = _anchor_hashes(parts.select("text"), length, piece).groupBy("anchor").agg(F.count("*").alias("total")).where("total > 1")
    shared = stored(spark, shared, "anchors", release=True)
    found = stored(spark, _places(parts, length, piece).join(shared, "anchor"), "places", release=True)
    place = F.struct("key", "mark", "p")
    # Different surroundings of an anchor, each with its first place.
    kinds = found.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max("total").alias("total"), F.max("fit").alias("fit"))
    kinds = stored(spark, kinds, "kinds", release=True)
    # Surroundings that occur more than once repeat as a whole; with keep_first all but the first of them.
    alike = found.select("key", "mark", "p", "anchor", "around").join(kinds.where("n > 1").select("anchor", "around", "first", "fit"), ["anchor", "around"])
    alike = alike.where(place != F.col("first")) if keep_first else alike
    behind = F.col("fit").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    spans = [alike.select("key", "mark", (F.col("p") - F.shiftright("fit", 32).cast("int")).alias("low"), (F.col("p") + behind).alias("high"))]
    if piece == length:
        return spans  # each window is all that surrounds it
    # Others, and with keep_first those that come first, may repeat in part.
    differing = kinds.where("n < total").withColumn("open", F.lit(True) if keep_first else F.col("n") == 1)
    crowded = differing.where(F.col("total") > MOST).groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > MOST).select("anchor")
    crowded = stored(spark, crowded, "crowded", release=True)
    apart = not crowded.isEmpty()
    few = differing.join(crowded, "anchor", "left_anti") if apart else differing
    for some in _in_turns(parts, few, 2 * length - piece):
        spans.append(stored(spark, _in_suffix_order(_surroundings(parts, some), length, piece, keep_first), "spans", release=True))
    if apart:
        regions = stored(spark, _regions(parts, differing.join(crowded, "anchor", "left_semi")), "regions", release=True)
        spans += _repeats(regions, length, _longer(length, piece), keep_first)
    return spans


def repeated(docs: DataFrame, length: int = LENGTH, piece: int = PIECE, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, runs): each document with the runs of bytes to remove, as pairs that may overlap."""
    spark = docs.sparkSession
    late = F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62)  # behind all usual ids
    key = F.coalesce(F.col(doc_id).cast("long"), late)
    named = docs.select(F.col(doc_id).cast("long").alias("id"), key.alias("key"), F.xxhash64(F.lit(1), F.col(text)).alias("mark"), F.col(text).alias("text"))
    spans = reduce(DataFrame.unionByName, _repeats(named.select("key", "mark", F.lit(0).alias("at"), "text"), length, piece, keep_first))
    packed = F.shiftleft(F.col("low").cast("long"), 32) + F.col("high")
    runs = spans.groupBy(F.col("key").alias("_k"), F.col("mark").alias("_m")).agg(F.collect_set(packed).alias("packed"))
    runs = stored(spark, runs, "runs", release=True)
    joined = named.join(runs, (F.col("key") == F.col("_k")) & (F.col("mark") == F.col("_m")), "left")
    low, high = (lambda x: F.shiftright(x, 32).cast("int")), (lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    return joined.select("id", "text", F.transform("packed", lambda x: F.struct(low(x).alias("low"), high(x).alias("high"))).alias("runs"))


def _merged(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that overlap or meet, of one owner, as one."""
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    far = np.maximum.accumulate(high + (owner << 40)) if len(owner) else high
    new = np.ones(len(owner), bool)
    new[1:] = low[1:] + (owner[1:] << 40) > far[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner))[: len(first)] - 1
    return owner[first], low[first], far[last] - (owner[first] << 40)


def digest(found: DataFrame) -> DataFrame:
    """Counts of removed bytes and runs, and a digest of what is left, of each document."""

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 1):
                data, ends = _bytes_of(batch.column(1))
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                runs = batch.column(2)
                owner = np.repeat(np.arange(len(ends)), runs.value_lengths().fill_null(0).to_numpy())
                low, high = (c.to_numpy().astype(np.int64) for c in runs.flatten().flatten())
                owner, low, high = _merged(owner, low, np.minimum(high, (ends - begins)[owner]))
                cut = np.searchsorted(owner, np.arange(len(ends) + 1))
                removed = np.concatenate([[0], np.cumsum(high - low)])
                raw, kept = memoryview(data), []
                for i, (a, b) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
                    left, last = sha256(), a
                    for x, y in zip(low[cut[i] : cut[i + 1]].tolist(), high[cut[i] : cut[i + 1]].tolist(), strict=True):
                        left.update(raw[last : a + x])
                        last = a + y
                    left.update(raw[last:b])
                    kept.append(left.hexdigest())
                arrays = [batch.column(0), pa.array(ends - begins), pa.array(removed[cut[1:]] - removed[cut[:-1]]), pa.array(np.diff(cut)), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
