"""Whole texts against brute force over all cuts, with ties, and against decoding."""

import random

import pytest

from bidmill.llm import pieces
from bidmill.llm.pieces import MARK


def small(scores, extra=0):
    """A vocabulary of the given pieces and the 256 bytes."""
    ids = {p: (300 + i, s) for i, (p, s) in enumerate(scores.items())}
    decoded = [bytes([b]) for b in range(256)] + [b""] * 44 + [p.replace(MARK, " ").encode() for p in ids] + [b""] * extra
    return pieces.vocabulary(ids, list(range(256)), decoded)


def brute(text, words):
    """Best cut of the marked text by all ways to end at each place; of equal ones the last piece is longer."""
    if not text:
        return []
    marked = [(c if c != " " else MARK, c == MARK) for c in " " + text]  # the text's own marks are no blanks
    best = [(0.0, [])]
    for end in range(1, len(marked) + 1):
        options = []
        for begin in range(end):
            piece, own = "".join(c for c, _ in marked[begin:end]), any(mark for _, mark in marked[begin:end])
            if not own and piece in words.pieces:
                options.append((best[begin][0] + words.pieces[piece][1], -begin, best[begin][1] + [words.pieces[piece][0]]))
        c, own = marked[end - 1]
        spelt = list(c.encode())
        if own or not options or not any(p.startswith(c) for p in words.pieces):
            options.append((best[end - 1][0] + words.byte_score * len(spelt), -(end - 1), best[end - 1][1] + [words.byte_ids[b] for b in spelt]))
        top = max(options, key=lambda o: o[:2])
        best.append((top[0], top[2]))
    return best[-1][1]


@pytest.mark.parametrize("seed", range(6))
def test_whole_texts_with_ties(seed):
    r = random.Random(seed)
    letters = "ab" + MARK
    scores = {c: -3.0 for c in letters if seed % 2 == 0 or c != "b"}
    while len(scores) < 14:
        body = "".join(r.choice("ab") for _ in range(r.randrange(1, 5)))
        scores.setdefault(r.choice(["", MARK]) + body, -float(r.randrange(1, 5)))  # few different scores: many ties
    words = small(scores)
    for _ in range(150):
        text = "".join(r.choice("aabb  é\n" + MARK) for _ in range(r.randrange(0, 25)))
        ids, same = words.encoder.checked(text)
        assert same and pieces.decode(ids.tolist(), words) == text
        if MARK not in text:
            assert ids.tolist() == brute(text, words)


def test_window_equals_streaming():
    words = pieces.load()
    r = random.Random(8)
    for _ in range(300):
        part = "".join(r.choice(["▁", "the", "er", "é", "漢", "\n", "😀", "tion", "x", "qz"]) for _ in range(r.randrange(1, 12)))
        assert pieces.search_window(part, words) == tuple(pieces.search(part, words))


def test_a_vocabulary_that_loses_text_is_told():
    words = small({"a": -1.0, "b": -1.0, MARK: -1.0})
    words.decoded[300] = b"?"
    assert words.encoder.checked("bb b")[1] and not words.encoder.checked("b a")[1]
    assert not words.encoder.checked("b a")[1]  # also when remembered


def test_long_texts_and_words():
    words = pieces.load()
    text = ("word " * 20_000 + "x" * 30_000 + "\n" + "é漢" * 5_000) * 2
    ids, same = words.encoder.checked(text)
    assert same and pieces.decode(ids.tolist(), words) == text


def test_ids_are_joined_by_part():
    """The ids of a text are those of its parts, and marks of its own are spelt."""
    words = pieces.load()
    for text in ("two words", "a▁b ▁▁ c", "▁", "\n x\n", "é😀"):
        ids, same = words.encoder.checked(text)
        assert same and ids.dtype == "int32" and pieces.decode(ids.tolist(), words) == text
        assert all(isinstance(part, bytes) for part in words.encoder.known.values())
