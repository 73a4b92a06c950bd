"""Benchmark decontamination by Wu-Manber search for many patterns at once.

Texts are sequences of words; a pattern is a window of consecutive words of a benchmark item. Each
word of the benchmark has a number, other words are 0, so that equal numbers are equal words. All
patterns of one length are searched together. A table over blocks of two words tells how far the
end of a pattern may be shifted at least; positions with a shift above 0 are skipped, the others
look up the bucket of their suffix hash, and each pattern in it is compared word by word.

Defined cases: null and empty texts have no words and no hits; items without words have no
windows; an item of fewer words than a window is one window. Equal windows of several items count
for each of them; repeated item rows count once. Windows of an item without an id can hit, but
the item is not listed. Rows are independent of each other, so null and repeated doc ids do no
harm. An empty benchmark gives no hits. The benchmark is read in blocks of BLOCK_ITEMS items; each
block is searched for in all documents, so any size of benchmark works and what is broadcast is bounded.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from bidmill.llm.common import unused

WINDOW = 10
BLOCK_BYTES = 8 << 20
CHUNK = 512
_BLOCK = 2
_SHIFTS = 1 << 20
#: Bytes that are no word characters, as blanks; A-Z in lower case.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(text: str | None) -> list[bytes]:
    # All other white space has become a blank, so this splits at blanks alone.
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_CLEAN).split()


@dataclass
class _Length:
    """Patterns of one length, with their tables."""

    length: int
    patterns: np.ndarray  # a row for each different pattern
    items: list[list[str]]
    shift: np.ndarray = field(init=False)
    block: int = field(init=False)
    hashes: np.ndarray = field(init=False)

    def __post_init__(self):
        self.block = min(_BLOCK, self.length)
        most = self.length - self.block + 1
        self.shift = np.full(_SHIFTS, most, np.uint8 if most < 256 else np.int32)
        for end in range(self.block, self.length + 1):
            at = _block_hash([self.patterns[:, end - 1 - k] for k in range(self.block)])
            np.minimum.at(self.shift, at, self.length - end)
        order = np.argsort(suffix := _suffix_hash(self.patterns), kind="stable")
        self.hashes, self.patterns = suffix[order], self.patterns[order]
        self.items = [self.items[i] for i in order]

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows that equal a pattern, and the pattern of each."""
        m = self.length
        if len(ids) < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        last = len(ids) - m + 1
        shifts = self.shift[_block_hash([ids[m - 1 - k : m - 1 - k + last] for k in range(self.block)])]
        starts = np.flatnonzero(shifts == 0)  # all other positions are skipped
        if not len(starts):
            return starts, starts
        windows = ids[starts[:, None] + np.arange(m)]
        suffix = _suffix_hash(windows)
        low, high = np.searchsorted(self.hashes, suffix, "left"), np.searchsorted(self.hashes, suffix, "right")
        found, which = [], []
        for k in range(int((high - low).max(initial=0))):  # the k-th pattern of each bucket
            at = np.flatnonzero(low + k < high)
            same = (self.patterns[low[at] + k] == windows[at]).all(axis=1)
            found.append(starts[at[same]])
            which.append((low[at] + k)[same])
        return (np.concatenate(found), np.concatenate(which)) if found else (starts[:0], starts[:0])


def _block_hash(words: list[np.ndarray]) -> np.ndarray:
    value = words[0].astype(np.uint32) * np.uint32(0x9E3779B1)
    for other in words[1:]:
        value = (value ^ other.astype(np.uint32)) * np.uint32(0x85EBCA77)
    return value >> np.uint32(12)


def _suffix_hash(windows: np.ndarray) -> np.ndarray:
    value = np.zeros(len(windows), np.uint64)
    for k in range(windows.shape[1]):
        value = (value ^ windows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


@dataclass
class Patterns:
    """All windows of a block of benchmark items."""

    numbers: dict[bytes, int]
    lengths: list[_Length]


def compile_items(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Patterns:
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in _words(text)]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            owners[tuple(ids[at : at + window])].update([] if item_id is None else [item_id])
    by_length = defaultdict(list)
    for pattern in owners:
        by_length[len(pattern)].append(pattern)
    return Patterns(numbers, [_Length(n, np.array(own, np.int32), [sorted(owners[p]) for p in own]) for n, own in sorted(by_length.items())])


def _scan(texts: list[str | None], patterns: Patterns) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text: its words, runs of hit words, and items with an occurrence.

    The texts are searched as one sequence with a 0 behind each, which no pattern contains.
    """
    get, sizes, ids = patterns.numbers.get, [], []
    for text in texts:
        words = _words(text)
        sizes.append(len(words))
        ids.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        ids.append(_GAP)
    whole = np.concatenate(ids) if ids else _GAP
    first = np.cumsum([0, *(n + 1 for n in sizes)])
    hits = np.zeros(len(whole) + 1, np.int32)
    items: list[set[str]] = [set() for _ in texts]
    for group in patterns.lengths:
        starts, which = group.occurrences(whole)
        np.add.at(hits, starts, 1)
        np.add.at(hits, starts + group.length, -1)
        for text, pattern in zip((np.searchsorted(first, starts, "right") - 1).tolist(), which.tolist(), strict=True):
            items[text].update(group.items[pattern])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(hits[:-1]) > 0, [0]])))
    runs: list[list[tuple[int, int]]] = [[] for _ in texts]
    for text, start, end in zip((np.searchsorted(first, edges[::2], "right") - 1).tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        runs[text].append((start - int(first[text]), end - int(first[text])))
    return list(zip(sizes, runs, map(sorted, items), strict=True))


_GAP = np.zeros(1, np.int32)

NEW_COLUMNS = ("n_words", "runs", "items")


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, names: tuple[str, str, str] = NEW_COLUMNS) -> DataFrame:
    """The rows with n_words, runs (start and end of hit words) and items (ids, as strings).

    A new column whose name is taken replaces that column; names gives others.
    """
    result, first = docs, True
    for patterns in _blocks(benchmark, window, block_bytes):
        result, first = _searched(result, patterns, text, first, names), False
    return result


def _blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """Patterns of blocks of items, of about block_bytes of text each; at least one block."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    block, size, given = [], 0, False
    for row in items.toLocalIterator():  # one partition of the benchmark at a time
        block.append((row.item_id, row.text))
        size += len(row.text or "")
        if size >= block_bytes:
            yield compile_items(block, window)
            block, size, given = [], 0, True
    if block or not given:
        yield compile_items(block, window)


def _searched(docs: DataFrame, patterns: Patterns, text: str, first: bool, new: tuple[str, str, str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]
    schema = StructType(kept)
    run_type = StructType().add("start", IntegerType()).add("end", IntegerType())
    for name, kind in zip(new, (LongType(), ArrayType(run_type), ArrayType(StringType())), strict=True):
        schema = schema.add(name, kind)
    pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            found = [x for at in range(0, batch.num_rows, CHUNK) for x in _scan(column[text].slice(at, CHUNK).to_pylist(), shared.value)]
            if not first:
                before = zip(column[new[1]].to_pylist(), column[new[2]].to_pylist(), strict=True)
                found = [(n, _joined(a, [(r["start"], r["end"]) for r in b]), sorted({*i, *j})) for (n, a, i), (b, j) in zip(found, before, strict=True)]
            runs = [[{"start": a, "end": b} for a, b in r] for _, r, _ in found]
            arrays = [pa.array([n for n, _, _ in found], pa.int64()), pa.array(runs, pairs), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(column[n] for n in names), *arrays], [*names, *new])

    return docs.mapInArrow(run, schema)


def _joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the items of each document."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Drop the documents in which a passage of the benchmark occurs."""
    names = tuple(unused(docs, n) for n in NEW_COLUMNS)
    return find_passages(docs, benchmark, names=names).where(F.size(names[1]) == 0).select(docs.columns)
