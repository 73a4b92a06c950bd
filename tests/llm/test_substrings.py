"""Repeated substrings against all windows, and what their steps leave on the disk."""

import random
import time

import numpy as np
import pytest

from bidmill.llm import substrings


def frame(spark, tmp_path, rows, name="d"):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path := str(tmp_path / name))
    return spark.read.parquet(path)


def removed(texts, length, keep_first):
    """Bytes to remove of each text, the texts in order of their ids."""
    places = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places.setdefault(t[i : i + length], []).append((d, i))
    gone = [set() for _ in texts]
    for where in places.values():
        for d, i in where[keep_first:] if len(where) > 1 else ():
            gone[d] |= set(range(i, i + length))
    return [len(g) for g in gone]


def odd_texts():
    r = random.Random(8)
    draw = lambda n: "".join(r.choices("abcdef", k=n))
    line, base = draw(70), draw(200)
    texts = [draw(30) + line[r.randrange(12) : r.choice([58, 64, 70])] + draw(30) for _ in range(50)]
    for _ in range(20):
        at = r.randrange(len(base))
        texts.append(base[:at] + draw(2) + base[at:])
    texts += [base, base, line * 3, "ab" * 40, "a" * 50, draw(9), "", (draw(13) * 9)[:100], draw(23), line[:24], line[:25]]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("crowded", [1, 20, 1000])
@pytest.mark.parametrize("keep_first", [False, True])
def test_all_windows_are_judged(spark, tmp_path, monkeypatch, crowded, keep_first):
    monkeypatch.setattr(substrings, "MOST", crowded)
    texts = odd_texts()
    docs = frame(spark, tmp_path, list(enumerate(texts[:-1])) + [(None, texts[-1]), (1000, None)])
    found = {x.doc_id: x.n_removed for x in substrings.digest(substrings.repeated(docs, length=24, piece=10, keep_first=keep_first)).collect()}
    expected = removed([*texts[:-1], "", texts[-1]], 24, keep_first)
    assert [found[i] for i in range(len(texts) - 1)] + [found[1000], found[None]] == expected


@pytest.mark.parametrize("bits", [64, 2, 0])
@pytest.mark.parametrize("earlier", [False, True])
def test_equal_hashes_of_different_windows(monkeypatch, bits, earlier):
    hashes = substrings._hashes_at
    monkeypatch.setattr(substrings, "_hashes_at", lambda *x: hashes(*x) & np.uint64((1 << bits) - 1))
    r = random.Random(bits)
    length, piece = 24, 10
    for _ in range(30):
        core = "".join(r.choices("ab", k=piece))
        sides = ["".join(r.choices("ab", k=5)) for _ in range(4)]
        texts = [(r.choice(sides) + "".join(r.choices("ab", k=9)) + r.choice(sides))[-14:] + core + (r.choice(sides) * 3)[:14] for _ in range(12)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        n = len(texts)
        low, high = substrings.matched(data, ends, np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64), np.full(n, length - piece), np.arange(n) % 3 > 0, length, piece, earlier)
        for i, t in enumerate(texts):
            others = texts[:i] if earlier else texts[:i] + texts[i + 1 :]
            hits = [k for k in range(len(t) - length + 1) if any(t[k : k + length] == o[k : k + length] for o in others)]
            # Windows at other offsets are judged by their own anchors; only an extra equal one may come in.
            anywhere = [k for k in range(len(t) - length + 1) if any(t[k : k + length] in o for o in others)]
            if not hits or i % 3 == 0:
                assert low[i] == -1 or (i % 3 and low[i] in anywhere)
            else:
                assert low[i] in anywhere and high[i] in anywhere and low[i] <= hits[0] and high[i] >= hits[-1]


def test_crowded_anchors_make_few_rows(spark, tmp_path, monkeypatch):
    """300 texts around one line: most windows are settled with longer pieces, without a row for each."""
    monkeypatch.setattr(substrings, "MOST", 100)
    counted, places_of = [], substrings._places

    def counting(parts, length, piece):
        counted.append((piece, (rows := places_of(parts, length, piece)).count()))
        return rows

    monkeypatch.setattr(substrings, "_places", counting)
    r = random.Random(9)
    line = "".join(r.choices("abcdefgh ", k=260))
    texts = ["".join(r.choices("abcdefgh ", k=300)) + line + "".join(r.choices("abcdefgh ", k=300)) for _ in range(300)]
    found = {x.doc_id: x.n_removed for x in substrings.digest(substrings.repeated(frame(spark, tmp_path, list(enumerate(texts))))).collect()}
    assert [found[i] for i in range(len(texts))] == removed(texts, substrings.LENGTH, False)
    assert [piece for piece, _ in counted] == [48, 124, 181, 200]
    assert sum(n for piece, n in counted if piece > substrings.PIECE) < len(texts) * 153  # as many as windows around one anchor


@pytest.mark.parametrize("keep_first", [False, True])
def test_surroundings_meet_in_turns(spark, tmp_path, monkeypatch, keep_first):
    """Few bytes of surroundings are shuffled at once, and each is judged in one of the turns."""
    monkeypatch.setattr(substrings, "_SHARE", 0.2)
    met, in_order = [], substrings._in_suffix_order

    def counting(rows, *args):
        met.append(sum(len(r.bytes) for r in rows.select("bytes").collect()))
        return in_order(rows, *args)

    monkeypatch.setattr(substrings, "_in_suffix_order", counting)
    texts = odd_texts()
    docs = frame(spark, tmp_path, list(enumerate(texts)))
    found = {x.doc_id: x.n_removed for x in substrings.digest(substrings.repeated(docs, length=24, piece=10, keep_first=keep_first)).collect()}
    assert [found[i] for i in range(len(texts))] == removed(texts, 24, keep_first)
    assert len(met) > 3 and max(met) < 0.4 * sum(map(len, texts)) < sum(met)


def test_steps_let_go_of_their_shuffled_files(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}

    docs = frame(spark, tmp_path, list(enumerate(odd_texts())))
    before = shuffled()
    found = substrings.repeated(docs, length=24, piece=10)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert found.count() == len(odd_texts())
