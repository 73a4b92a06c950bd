"""Near-duplicate documents by SimHash, compared in bit slices.

A fingerprint holds for each of 64 bits whether more than half of a text's word shingles have it set in
their hash. Documents with equal fingerprints are one node from the start. Two fingerprints that
differ in at most RADIUS = 2 of 64 bits agree on at least two quarters, so candidates share a bucket: two quarters of
16 bits. A bucket of over CROWDED different fingerprints is split by the same rule again, its other 32 bits
into quarters of 8 bits, and those over CROWDED once more into quarters of 4: then 8 bits are free and no bucket can hold more than 256.
No pair is lost, as each rule holds for any two that differ in at most two bits.

Buckets are compared in bit slices: 64 planes hold one bit of every fingerprint of a run of buckets, in the
order of the buckets. Planes are compared with themselves moved by 1, 2, ... places, so that 64 pairs
meet in each word; carry-save counters of two planes add up differences in all of them at once, starting so that they run
over beyond the radius. Words whose pairs have all run over, or are linked already, are abandoned. A bucket
gives no pairs but one link for each fingerprint to the first of its class there, so what it gives is linear
in its size. Components come from alternating large-star and small-star.

Defined cases: null text, and text without words, has fingerprint zero, linked like any other. Null
ids: such documents are linked like others, but a component's id is its smallest id that is not null,
null if there is none. Rows may repeat. No documents give no rows. Texts are read whole, in pieces.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import LOWER, as_bytes, stored
from bidmill.llm.components import components

SEED = 42
RADIUS = 2
#: A bucket of more different fingerprints is split further.
CROWDED = 512
#: Bytes of a text that are cut into words at once, hashes that are counted at once, lanes compared at once.
_PIECE = 1 << 20
_COUNTED = 1 << 15
_LANES = 1 << 16
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _quarters(free: list[int]) -> list[tuple[int, list[int]]]:
    """Six ways to hold half of some bits: the mask, and the bits that stay free."""
    size = len(free) // 4
    parts = [free[k * size : (k + 1) * size] for k in range(4)]
    ways = []
    for held in combinations(range(4), 2):
        mask = sum(1 << b for k in held for b in parts[k])
        ways.append((mask, [b for k in range(4) if k not in held for b in parts[k]]))
    return ways


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _levels() -> list[list[int]]:
    """Masks of buckets by code, for each level; the codes 6 * c to 6 * c + 5 split the bucket kind c of the level before."""
    known, levels = [(0, list(range(64)))], []
    for _ in range(3):
        known = [(mask | more, rest) for mask, free in known for more, rest in _quarters(free)]
        levels.append([_signed(mask) for mask, _ in known])
    return levels


MASKS = _levels()


def _pieces(data: bytes):
    """Lists of the words of a text's pieces, none of them cut."""
    at = 0
    while at < len(data):
        blank = _BLANK.search(data, at + _PIECE)
        end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


def shingle_hashes(text: str | None, words: int = 3):
    """Lists of the hashes of a text's shingles, repeats included."""
    carry: list[bytes] = []
    seen, digest = False, xxhash.xxh64_intdigest
    for own in _pieces(as_bytes(text).translate(LOWER)):
        own = carry + own
        carry = own[max(0, len(own) - words + 1) :]
        if len(own) >= words:
            seen = True
            yield [digest(b" ".join(shingle), SEED) for shingle in zip(*(own[k:] for k in range(words)), strict=False)]
    if not seen and carry:
        yield [digest(b" ".join(carry), SEED)]


def _ones(hashes: list[int], starts: list[int]) -> np.ndarray:
    """How often each bit is set between starts (each below the next)."""
    flat = np.fromiter(hashes, np.uint64, len(hashes))
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints(texts: list[str | None], words: int = 3) -> np.ndarray:
    """64-bit fingerprints; bits are set if they are in over half of the hashes."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    hashes, starts, owners = [], [], []

    def count():
        if hashes:
            np.add.at(ones, owners, _ones(hashes, starts))
        for gone in (hashes, starts, owners):
            gone.clear()

    for i, text in enumerate(texts):
        for part in shingle_hashes(text, words):
            for at in range(0, len(part), _COUNTED):
                some = part[at : at + _COUNTED]
                owners.append(i)
                starts.append(len(hashes))
                hashes.extend(some)
                total[i] += len(some)
                if len(hashes) >= _COUNTED:
                    count()
    count()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _marked(words: int):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                marks = fingerprints(batch.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["id", "mark"])

    return run


def _buckets(marks: DataFrame) -> DataFrame:
    """(level, code, held, mark): each fingerprint in its buckets, crowded ones split."""
    spark = marks.sparkSession

    def split(rows: DataFrame, level: int) -> DataFrame:
        """Rows (mark, code) of one level by the kinds of bucket of the next."""
        masks = F.array(*[F.lit(m).cast("long") for m in MASKS[level]])
        ways = rows.select("mark", (F.col("code") * 6).alias("base"), F.posexplode(F.slice(masks, F.col("code") * 6 + 1, 6)).alias("way", "mask"))
        return ways.select("mark", (F.col("base") + F.col("way")).alias("code"), F.col("mark").bitwiseAND(F.col("mask")).alias("held"), F.lit(level).alias("level"))

    parts, todo = [], split(marks.select("mark", F.lit(0).alias("code")), 0)
    for level in (1, 2):
        crowded = todo.groupBy("code", "held").agg(F.count("*").alias("size")).where(F.col("size") > CROWDED).select("code", "held")
        crowded = stored(spark, crowded, "crowded")
        if crowded.isEmpty():
            break
        parts.append(todo.join(crowded, ["code", "held"], "left_anti").select("level", "code", "held", "mark"))
        todo = split(todo.join(crowded, ["code", "held"], "left_semi").select("mark", "code"), level)
    out = todo.select("level", "code", "held", "mark")
    for part in parts:
        out = out.unionAll(part)
    return out


def _planes(marks: np.ndarray) -> np.ndarray:
    """One bit of all fingerprints in each row, 64 lanes a word, and a word of padding behind."""
    n = len(marks)
    bits = np.zeros((64, (n + 63) // 64 * 64 + 64), np.uint8)
    bits[:, :n] = np.unpackbits(marks.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _moved(plane: np.ndarray, words: np.ndarray, far: int) -> np.ndarray:
    """The given words of a plane that is moved down by some lanes."""
    whole, part = divmod(far, 64)
    low = plane[words + whole]
    if not part:
        return low
    return low >> np.uint64(part) | plane[words + whole + 1] << np.uint64(64 - part)


def within(planes: np.ndarray, words: np.ndarray, skip: np.ndarray, far: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and in them the lanes whose fingerprint is close to the one `far` lanes on; skip are lanes not asked for."""
    size = max(1, radius.bit_length())
    start = (1 << size) - 1 - radius
    over = skip.copy()
    counter = [np.full(len(words), _ALL if start >> k & 1 else 0, np.uint64) for k in range(size)]
    for b in range(64):
        carry = planes[b][words] ^ _moved(planes[b], words, far)
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if b % 8 == 7:
            open_ = over != _ALL
            if not open_.all():
                words, over, counter = words[open_], over[open_], [c[open_] for c in counter]
                if not len(words):
                    break
    return words, ~over


def links_of(marks: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Lanes and the first lane of their class, of buckets that end (exclusive) at ends[lane]."""
    n = len(marks)
    planes, lanes = _planes(marks), np.arange(n)
    top = lanes.copy()

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return int(x)

    asked = lanes
    for far in range(1, n):
        asked = asked[asked + far < ends[asked]]
        if not len(asked):
            break
        apart = asked[top[asked] != top[asked + far]]
        if not len(apart):
            continue
        words, at = np.unique(apart // 64, return_inverse=True)
        skip = np.full(len(words), _ALL, np.uint64)
        np.bitwise_xor.at(skip, at, np.uint64(1) << (apart % 64).astype(np.uint64))
        words, close = within(planes, words, skip, far, radius)
        hit = np.flatnonzero(np.unpackbits(close.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").ravel())
        for lane in (words[hit // 64] * 64 + hit % 64).tolist() if len(hit) else ():
            a, b = sorted((find(lane), find(lane + far)))
            top[b] = a
        if len(hit):
            while (top[top] != top).any():
                top[:] = top[top]
    linked = np.flatnonzero(top != lanes)
    return linked, top[linked]


def _compared(batches):
    """Links (a, b) of sorted rows (level, code, held, mark); a bucket may go on in the next batch."""

    def links(kinds, held, marks):
        change = np.flatnonzero((kinds[1:] != kinds[:-1]) | (held[1:] != held[:-1])) + 1
        cuts = np.concatenate([[0], change, [len(marks)]])
        ends = np.repeat(cuts[1:], np.diff(cuts))
        a, b = links_of(marks.view(np.uint64), ends)
        return pa.RecordBatch.from_arrays([pa.array(marks[a]), pa.array(marks[b])], ["a", "b"])

    left = [np.zeros(0, np.int64)] * 3
    for whole in batches:
        kinds = whole.column(0).to_numpy(zero_copy_only=False).astype(np.int64) * 256 + whole.column(1).to_numpy(zero_copy_only=False)
        rows = [np.concatenate(x) for x in zip(left, (kinds, whole.column(2).to_numpy(zero_copy_only=False), whole.column(3).to_numpy(zero_copy_only=False)), strict=True)]
        if len(rows[0]) < _LANES:
            left = rows
            continue
        change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        if len(change):
            yield links(*(x[: change[-1]] for x in rows))
            rows = [x[change[-1] :] for x in rows]
        left = rows
    if len(left[0]):
        yield links(*left)


def near_duplicates(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, mark, component_id) for each document; mark is its fingerprint as a signed number."""
    spark = docs.sparkSession
    signed = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_marked(words), "id long, mark long")
    signed = stored(spark, signed, "fingerprints")
    nodes = stored(spark, signed.groupBy("mark").agg(F.min("id").alias("id")), "nodes")
    dealt = _buckets(nodes.select("mark")).repartition("level", "code", "held").sortWithinPartitions("level", "code", "held", "mark")
    links = stored(spark, dealt.mapInArrow(_compared, "a long, b long").distinct(), "links")
    groups = components(links)
    of_node = nodes.join(groups.select(F.col("node").alias("mark"), "component"), "mark", "left")
    of_node = stored(spark, of_node.select("mark", "id", F.coalesce("component", "mark").alias("component")), "classes")
    least = of_node.groupBy("component").agg(F.min("id").alias("component_id"))
    return signed.join(of_node.select("mark", "component").join(least, "component").select("mark", "component_id"), "mark").select("id", "mark", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """A row for each document with its fingerprint in hexadecimal digits and its component."""
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id")
