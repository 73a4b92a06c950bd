"""Words that a weak hash would mix up, and how work grows with a group of near copies."""

import random

import numpy as np
import pytest

from bidmill.llm import minhash


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096, 1 << 17])
def test_thue_morse_words_are_different(n):
    one, two = minhash.shingle_sets([f"p {thue_morse(n)} q r", f"p {thue_morse(n, 'ba')} q r"], 3)
    assert len(one) == len(two) == 2 and not set(one.tolist()) & set(two.tolist())


def test_documents_with_thue_morse_words_stay_apart(spark, tmp_path):
    rows = [(1, f"p {thue_morse(1024)} q r"), (2, f"p {thue_morse(1024, 'ba')} q r")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path := str(tmp_path / "d"))
    found = minhash.digest(minhash.near_duplicates(spark.read.parquet(path), 3, 85)).collect()
    assert {r.doc_id: r.kept for r in found} == {1: True, 2: True}


def test_shared_counts_against_sets(monkeypatch):
    r = random.Random(3)
    sets = [[np.array(sorted(r.sample(range(-40, 40), r.randrange(30))), np.int64) for _ in range(n)] for n in (9, 13)]
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[1]] for a in sets[0]]
    for columns in (1, 7, 4096):
        monkeypatch.setattr(minhash, "_COLUMNS", columns)
        assert minhash.shared_counts(*sets).tolist() == expected


def test_rows_grow_with_the_members_of_a_group(spark, tmp_path, monkeypatch):
    """Two groups of copies with few changes, some words apart, so that they share buckets but no link."""
    r = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    base = [r.choice(words) for _ in range(200)]
    other = [w if i % 17 else r.choice(words) for i, w in enumerate(base)]
    texts = []
    for k in range(2000):
        own = list(base if k % 2 else other)
        for _ in range(2):
            own[r.randrange(len(own))] = r.choice(words)
        texts.append(" ".join(own))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path := str(tmp_path / "g"))
    written = {}

    def noted(session, df, what, keep=minhash.stored):
        out = keep(session, df, what)
        written.setdefault(what, []).append(out.count())
        return out

    monkeypatch.setattr(minhash, "stored", noted)
    monkeypatch.setattr(minhash, "_BLOCK", 64)
    found = {x.doc_id: x.component_id for x in minhash.digest(minhash.near_duplicates(spark.read.parquet(path), 3, 85)).collect()}
    assert set(found.values()) == {0, 1} and all(v == k % 2 for k, v in found.items())
    bands = minhash.HASHES // minhash.ROWS
    assert max(written["compared"]) <= 2000 * bands and max(written["inside"]) <= 2000 * bands
    assert written["found"][-1] <= 2000 * bands
