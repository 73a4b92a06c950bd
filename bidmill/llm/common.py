"""Helpers that several operators share."""

from __future__ import annotations

import re
from contextlib import contextmanager, nullcontext
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from bidmill.checks.workspace import new_folder

#: A-Z to a-z and everything else as it is, for bytes.translate.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS = 1 << 21
_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")
#: Bytes of a text that are cut into words at once.
_PIECE = 1 << 20


#: Whether a query's shuffled files go when it ends, not when the driver collects its garbage.
_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def letting_go(spark: SparkSession):
    """Within it, what a query shuffles goes as soon as the query ends."""
    before = spark.conf.get(_LET_GO, None)
    spark.conf.set(_LET_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_LET_GO) if before is None else spark.conf.set(_LET_GO, before)


def stored(spark: SparkSession, df: DataFrame, what: str, release: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps start from the files.

    With release, what was shuffled for it goes as soon as it is written.
    """
    path = new_folder(spark, what)
    with letting_go(spark) if release else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hash_limit(share: float) -> int:
    """The 64-bit hash up to which the given share of evenly spread hashes lies."""
    return min((1 << 63) - 1, int(min(1.0, share) * (1 << 64)) - (1 << 63))


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def word_lists(data: bytes):
    """Lists of the words between ASCII white space, for a text's pieces; no word is cut."""
    at = 0
    while at < len(data):
        blank = _BLANK.search(data, at + _PIECE)
        end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


@lru_cache(1)
def byte_powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, powers of the base, and powers of its inverse modulo 2**64."""
    values = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    up = np.full(_POWERS, _BASE, np.uint64)
    down = np.full(_POWERS, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair, equal for equal bytes at any place.

    The bytes are taken in pieces, so that tables of powers stay small; spans are sorted by
    start. Spans longer than a piece are summed over several.
    """
    values, up, down = byte_powers()
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        base = int(starts[done])
        upto = done + int(np.searchsorted(starts[done:], base + _POWERS // 2, "right"))
        last = int(ends[done:upto].max())
        while last - base >= _POWERS:  # a long span near the end: fewer spans in this piece
            upto = done + max(1, (upto - done) // 2)
            last = int(ends[done:upto].max())
            if upto == done + 1:
                break
        if last - base >= _POWERS:
            out[done:upto] = _long_hash(data[base:last])
            done = upto
            continue
        sums = np.zeros(last - base + 1, np.uint64)
        np.cumsum(values[data[base:last]] * down[: last - base], out=sums[1:])
        first, end = starts[done:upto] - base, ends[done:upto] - base
        out[done:upto] = mixed((sums[end] - sums[first]) * up[first] + (end - first).astype(np.uint64))
        done = upto
    return out


def _long_hash(data: np.ndarray) -> np.ndarray:
    """The hash of all bytes as one span, from the sums of its pieces."""
    values, _, down = byte_powers()
    total = 0
    for at in range(0, len(data), _POWERS):
        part = data[at : at + _POWERS]
        own = int((values[part] * down[: len(part)]).sum(dtype=np.uint64))
        total += own * pow(_BASE, -at, 1 << 64)
    return mixed(np.array([(total + len(data)) & _MASK], np.uint64))


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
