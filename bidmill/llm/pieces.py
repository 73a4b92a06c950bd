"""SentencePiece encoding by streaming Viterbi, and decoding.

Blanks become the mark U+2581 and one mark is put in front. Among all ways to cut the marked text
into pieces of the vocabulary, that with the highest sum of scores is taken; of equal ones, that
whose last piece is longer, and so on backwards. A character without a piece of its own can also
be written as the ids of its UTF-8 bytes, as can a mark that stands in the text itself.

The search keeps a window bounded by the longest piece: after each step it follows the back pointers of
all positions from which a piece may still reach further. Where they meet, everything in front is
final and its ids are given out. No piece goes across some places: from a letter to a mark, and
around characters that are in no piece. All paths meet there, so the parts between them are
searched separately, and equal parts are searched, and decoded again, once for each task.

Defined cases: null text has null ids, no tokens and a null round trip; empty text has no ids and
decodes to empty text. Texts of any length are encoded whole. Rows are independent of each other,
so null and repeated ids do no harm. A new column whose name is taken replaces that column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

from bidmill.llm.common import as_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Parts that a Python process remembers; then it starts anew.
REMEMBERED = 400_000
_INFINITE = float("inf")


@dataclass
class Vocabulary:
    """Pieces with their ids and scores, and the ids of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    byte_score: float
    decoded: list[bytes]
    longest: int
    parts: str  # pattern of the parts that are searched separately; empty if there are no such places

    @cached_property
    def tree(self) -> dict:
        """Pieces by character: the next level, and the ids and score of the piece that ends here."""
        top: dict = {}
        for piece, (own, value) in sorted(self.pieces.items()):
            level = top
            for c in piece[:-1]:
                level = level.setdefault(c, ({}, None, 0.0))[0]
            level[piece[-1]] = (level[piece[-1]][0] if piece[-1] in level else {}, (own,), value)
        return top

    @cached_property
    def encoder(self) -> Encoder:
        """One for each Python process that has this vocabulary, with what it remembers."""
        return Encoder(self)


def load(model: str = MODEL) -> Vocabulary:
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, byte_ids = {}, [-1] * 256
    decoded = [b""] * own.get_piece_size()
    for i in range(own.get_piece_size()):
        if own.is_byte(i):
            value = int(own.id_to_piece(i)[3:5], 16)
            byte_ids[value], decoded[i] = i, bytes([value])
        elif not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i)):
            pieces[own.id_to_piece(i)] = (i, own.get_score(i))
            decoded[i] = own.id_to_piece(i).replace(MARK, " ").encode()
    return vocabulary(pieces, byte_ids, decoded)


def vocabulary(pieces: dict[str, tuple[int, float]], byte_ids: list[int], decoded: list[bytes]) -> Vocabulary:
    if -1 in byte_ids:
        raise ValueError("the vocabulary must have all 256 bytes")
    crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
    alone = "" if any("\n" in p for p in pieces) else "\n"
    other = f"[^{MARK}{alone}]"
    parts = "" if crossing else (f"{MARK}+{other}*|{other}+" + (f"|{alone}" if alone else ""))
    lowest = min((s for _, s in pieces.values()), default=0.0)
    return Vocabulary(pieces, byte_ids, lowest - 10.0, decoded, max(map(len, pieces), default=1), parts)


def search(text: str, words: Vocabulary):
    """Ids of the best cut of a marked text, given out as soon as they are final."""
    tree, longest = words.tree, words.longest
    # Of the places after base that are reached: best score, start of the last piece, its ids.
    base, score, start, ids = 0, [0.0], [0], [()]
    for begin in range(len(text)):
        so_far = score[begin - base]
        place, node = begin - base, tree
        for at in range(begin, min(begin + longest, len(text))):
            if (step := node.get(text[at])) is None:
                break
            place += 1
            if place == len(score):
                score.append(-_INFINITE)
                start.append(begin)
                ids.append(())
            node, own, value = step
            if own is not None and so_far + value > score[place]:
                score[place], start[place], ids[place] = so_far + value, begin, own
        place = begin - base + 1
        if place == len(score) or score[place] == -_INFINITE or text[begin] not in tree:
            spelt = as_bytes(text[begin])
            if place == len(score):
                score.append(-_INFINITE)
                start.append(begin)
                ids.append(())
            if so_far + words.byte_score * len(spelt) > score[place]:
                score[place], start[place] = so_far + words.byte_score * len(spelt), begin
                ids[place] = tuple(words.byte_ids[b] for b in spelt)
        if begin + 1 == len(text):
            alive = {begin + 1}
        elif begin - base >= 2 * longest and begin % longest == 0:
            # All places reached behind begin: each cut of the rest goes through one of them.
            alive = {base + k for k in range(place, len(score)) if score[k] > -_INFINITE}
        else:
            continue
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(start[last - base])
        (meet,) = alive
        path, at = [], meet
        while at > base:
            path.append(ids[at - base])
            at = start[at - base]
        for own in reversed(path):
            yield from own
        if meet > base:
            low = score[meet - base]
            score, start, ids = [x - low for x in score[meet - base :]], start[meet - base :], ids[meet - base :]
            base = meet


def search_window(text: str, words: Vocabulary) -> tuple[int, ...]:
    """As `search`, for a text that fits into the window: no path has to end before the text does."""
    tree, n = words.tree, len(text)
    score, start, ids = [0.0] + [-_INFINITE] * n, [0] * (n + 1), [()] * (n + 1)
    for begin in range(n):
        so_far, node, place = score[begin], tree, begin
        for c in text[begin:]:
            if (step := node.get(c)) is None:
                break
            node, own, value = step
            place += 1
            if own is not None and so_far + value > score[place]:
                score[place], start[place], ids[place] = so_far + value, begin, own
        if score[begin + 1] == -_INFINITE or text[begin] not in tree:
            spelt = as_bytes(text[begin])
            value = so_far + words.byte_score * len(spelt)
            if value > score[begin + 1]:
                score[begin + 1], start[begin + 1], ids[begin + 1] = value, begin, tuple(words.byte_ids[b] for b in spelt)
    path, at = [], n
    while at:
        path.append(ids[at])
        at = start[at]
    return tuple(chain.from_iterable(reversed(path)))


class _Parts(dict):
    """Ids of parts (as the bytes of 32-bit numbers), searched and decoded again when first asked for."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words = words
        self.broken: set[str] = set()  # parts that their ids do not give back

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        short = len(part) <= 2 * self.words.longest
        found = search_window(part, self.words) if short else tuple(search(part, self.words))
        if b"".join(map(self.words.decoded.__getitem__, found)) != as_bytes(part.replace(MARK, " ")):
            self.broken.add(part)
        packed = self[part] = np.array(found, np.int32).tobytes()
        return packed


class Encoder:
    def __init__(self, words: Vocabulary):
        self.words = words
        self.known = _Parts(words)
        self.split = re.compile(words.parts).findall if words.parts else lambda text: [text]

    def encode(self, text: str) -> np.ndarray:
        return self.checked(text)[0]

    def checked(self, text: str) -> tuple[np.ndarray, bool]:
        """The ids, and whether they decode to the text.

        Each part was decoded when it was searched, so that only their join has to be compared.
        """
        if not text:
            return np.zeros(0, np.int32), True
        if MARK in text:  # spell the text's own marks as bytes
            spelt = [self.words.byte_ids[b] for b in MARK.encode()]
            same = b"".join(self.words.decoded[i] for i in spelt) == MARK.encode()
            out: list[bytes] = []
            for between in text.split(MARK):
                ids, own = self._ids(("" if out else MARK) + between.replace(" ", MARK))
                out.append(ids)
                same = same and own
            return np.frombuffer(np.array(spelt, np.int32).tobytes().join(out), np.int32), same
        ids, same = self._ids(MARK + text.replace(" ", MARK))
        return np.frombuffer(ids, np.int32), same

    def _ids(self, marked: str) -> tuple[bytes, bool]:
        """The ids as the bytes of 32-bit numbers, joined by part and not by id, and whether they decode to the text."""
        if not marked:
            return b"", True
        parts = self.split(marked)
        found = b"".join(map(self.known.__getitem__, parts))
        broken = self.known.broken
        return found, "".join(parts) == marked and (not broken or broken.isdisjoint(parts))


def decode(ids, words: Vocabulary) -> str:
    """The text of ids: pieces and bytes joined, without the first blank."""
    joined = b"".join(map(words.decoded.__getitem__, ids)).decode("utf-8", "surrogatepass")
    return joined[1:] if joined.startswith(" ") else joined


NEW_COLUMNS = ("ids", "n_tokens", "round_trip")


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", drop_text: bool = False) -> DataFrame:
    """The rows with ids, n_tokens and round_trip (whether the decoded ids are the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    kept = [f for f in docs.schema.fields if f.name.lower() not in NEW_COLUMNS and not (drop_text and f.name == text)]
    names = [f.name for f in kept]
    schema = StructType(kept)
    for name, kind in zip(NEW_COLUMNS, (ArrayType(IntegerType()), LongType(), BooleanType()), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        words = shared.value
        encoder = words.encoder
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                texts = column[text].to_pylist()
                ids, same = zip(*[(None, None) if t is None else encoder.checked(t) for t in texts], strict=True)
                sizes = [0 if i is None else len(i) for i in ids]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                flat = np.concatenate([np.zeros(0, np.int32), *(i for i in ids if i is not None)])
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array([i is None for i in ids], pa.bool_()))
                arrays = [lists, pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(column[n] for n in names), *arrays], [*names, *NEW_COLUMNS])

    return docs.mapInArrow(run, schema)
