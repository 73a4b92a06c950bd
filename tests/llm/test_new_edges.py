"""Hard inputs of fingerprints, spelling variants and conversations, on small tables."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidmill.llm import line_dedup, repair, simhash, spelling


def frame(spark, tmp_path, rows, schema, name="t"):
    spark.createDataFrame(rows, schema).write.parquet(path := str(tmp_path / name))
    return spark.read.parquet(path)


def classes(marks, radius):
    parent = list(range(len(marks)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= radius:
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return [root(i) for i in range(len(marks))]


# Fingerprints.


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_slices_against_bit_counts(radius):
    r = random.Random(radius)
    marks = [r.getrandbits(64) for _ in range(40)]
    for _ in range(260):
        own = r.choice(marks)
        for _ in range(r.randrange(5)):
            own ^= 1 << r.randrange(64)
        marks.append(own)
    cuts = sorted({0, 300, *(r.randrange(300) for _ in range(6))})
    ends = np.repeat(cuts[1:], np.diff(cuts))
    lanes, tops = simhash.links_of(np.array(marks, np.uint64), ends, radius)
    found = list(range(300))
    for lane, top in zip(lanes.tolist(), tops.tolist(), strict=True):
        found[lane] = top
    expected = [a + x for a, b in itertools.pairwise(cuts) for x in classes(marks[a:b], radius)]
    assert found == expected


@pytest.mark.parametrize("crowded", [3, 512])
def test_crowded_buckets_lose_no_link(spark, tmp_path, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    r = random.Random(9)
    marks = {r.getrandbits(64) for _ in range(50)}
    centre = r.getrandbits(64)
    for _ in range(600):  # many around one centre, some far from it in the same buckets
        own = centre
        for _ in range(r.choice([1, 2, 3, 4, 9])):
            own ^= 1 << r.randrange(64)
        marks.add(own)
    marks = sorted(marks)
    table = frame(spark, tmp_path, [(m - (1 << 64) if m >> 63 else m,) for m in marks], "mark long")
    rows = simhash._buckets(table)
    assert rows.groupBy("level", "code", "held").count().where(f"level < 2 and count > {crowded}").isEmpty()
    links = rows.repartition("level", "code", "held").sortWithinPartitions("level", "code", "held", "mark").mapInArrow(simhash._compared, "a long, b long").collect()
    assert len(links) <= rows.count()
    parent = {m: m for m in marks}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = a & (1 << 64) - 1, b & (1 << 64) - 1
        assert a != b
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    expected = classes(marks, 2)
    assert [root(m) for m in marks] == [marks[i] for i in expected]


def test_texts_in_pieces_have_the_same_fingerprint(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(r.choice(["aa", "B", "cçc", "d" * 30]) for _ in range(n)) + end for n in (0, 1, 2, 3, 50, 400) for end in ("", " \n", "\t")]
    whole = simhash.fingerprints([*texts, None])
    monkeypatch.setattr(simhash, "_PIECE", 7)
    monkeypatch.setattr(simhash, "_COUNTED", 5)
    assert (simhash.fingerprints([*texts, None]) == whole).all()


def test_documents_without_words_and_ids(spark, tmp_path):
    prose = "one two three four five six"
    rows = [(4, None), (3, " \n"), (9, prose), (None, prose), (8, prose.upper()), (8, prose), (5, "x"), (None, "only here")]
    docs = frame(spark, tmp_path, rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("mark", "id", "code", "component")})
    found = simhash.digest(simhash.near_duplicates(docs)).collect()
    said = sorted((r.doc_id or 0, r.component_id or 0) for r in found)
    assert said == [(0, 0), (0, 8), (3, 3), (4, 3), (5, 5), (8, 8), (8, 8), (9, 8)]
    assert {r.fingerprint for r in found if r.doc_id in (3, 4)} == {"0" * 16}
    assert simhash.near_duplicates(docs.where("false")).isEmpty()


# Spelling variants.


def brute_variants(counts):
    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in counts.items():
        others = sorted((-m, x) for x, m in counts.items() if near(w, x))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.mark.parametrize("long", [3, 64])
def test_variants_against_all_pairs(spark, tmp_path, monkeypatch, long):
    # Executors read the module anew, so the short limit is set in them, too.
    r = random.Random(long)
    counts = {}
    while len(counts) < 250:
        w = "".join(r.choice("abé") for _ in range(r.randrange(5, 9)))
        counts[w] = r.choice([3, 3, 4, 6, 7, 12, 13, 40])
    rows = []
    monkeypatch.setattr(spelling, "LONG", long)
    for own, (w, n) in enumerate(sorted(counts.items(), key=lambda x: x[0].encode())):
        rows += [(p, own, n, kind) for p, kind in spelling.prefixes(w)]
    names = sorted(counts, key=str.encode)
    monkeypatch.setattr(spelling, "_rotated", lambda batches: batches)
    words = frame(spark, tmp_path, rows, "prefix binary, id long, n long, kind tinyint").withColumn("word", F.lit(""))

    class Rotated:
        def select(self, *_):
            return self

        def mapInArrow(self, *_):
            return words.select("prefix", "id", "n", "kind")

    found = {names[x.id]: (x.n_near, names[x.best.id], -x.best.less) for x in spelling.neighbours(Rotated()).collect()}
    for w, (form, _, n, k, m) in brute_variants(counts).items():
        got = found.get(w, (0, None, 0))
        assert got[0] == k
        assert (got[1] if got[2] >= 2 * n else None) == form and (m is None or got[2] == m)


def test_chains_ties_and_hard_texts(spark, tmp_path, monkeypatch):
    texts = {
        1: "colour " * 3 + "colours " * 8 + "colourss " * 16 + "COLOURSSS " * 32, 2: None, 3: "", 4: "tiger tiger tiger, tigerx tigery " * 3,
        5: "Ärzte1Ärzte-Ärzte ärzte " + "x" * 200_000, 6: "abcd " * 9, 7: ("y" * 5000 + " ") * 3 + ("y" * 5001 + " ") * 6,
    }
    docs = frame(spark, tmp_path, [*texts.items(), (None, "colour")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "n", "word", "prefix", "form")})
    found = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.group(docs).collect()}
    import collections
    import zlib

    counts = collections.Counter()
    for doc, text in [*texts.items(), ("", "colour")]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    counts = {w: n for w, n in counts.items() if n >= 3}
    assert found == brute_variants(counts)
    assert found["colour"][:2] == ("colours", "coloursss") and found["tigerx"][0] == "tiger" and found["y" * 5000][0] == "y" * 5001
    assert spelling.group(docs.where("false")).isEmpty()


def test_runs_in_pieces(monkeypatch):
    text = "ab cd, " * 30 + "long" * 40 + "!" + "é" * 9
    whole = [w for runs in spelling._runs(text) for w in runs]
    for size in (1, 2, 5, 64):
        monkeypatch.setattr(spelling, "_PIECE", size)
        assert [w for runs in spelling._runs(text) for w in runs] == whole


# Conversations.


def brute_repair(codes):
    """Cheapest audit over all edits by layers of (place, state), texts compared as a whole."""
    best = {(0, 0): (0, "")}
    for at in range(len(codes) + 1):
        for _ in range(4):  # inserts
            for state in range(4):
                if (at, state) in best:
                    c, a = best[at, state]
                    key = at, repair._NEXT[state]
                    best[key] = min(best.get(key, (10**9, "")), (c + 5, a + "I"))
        if at == len(codes):
            break
        role, fault = codes[at] >> 3, codes[at] & 7
        for state in range(4):
            if (at, state) not in best:
                continue
            c, a = best[at, state]
            options = [(state, 2, "D")]
            if fault in (repair._SOUND, repair._CUT):
                extra = 5 * (fault == repair._CUT)
                options.append((repair._NEXT[state], 1 + extra, "R"))
                if (after := repair._AFTER.get((state, role))) is not None:
                    options.append((after, extra, "K"))
            for after, cost, name in options:
                key = at + 1, after
                best[key] = min(best.get(key, (10**9, "")), (c + cost, a + name))
    return min(best[len(codes), s] for s in (0, 3) if (len(codes), s) in best)


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_search_against_all_edits(monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    repair._known.cache_clear()
    r = random.Random(segment)
    for _ in range(400):
        codes = bytes(r.choice([0, 1, 1, 2, 2, 3]) * 8 + r.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(r.randrange(0, 14)))
        cost, audit = repair.cheapest(codes)
        expected = brute_repair(codes)
        assert cost == expected[0] and (audit == expected[1])


def test_long_conversations_take_time_in_proportion():
    r = random.Random(3)
    codes = bytes((1 + i % 2) * 8 + r.choice([0] * 17 + [1, 2, 3]) for i in range(20_000))
    cost, audit = repair.cheapest(codes)
    assert len(audit.replace("I", "")) == 20_000
    assert cost == 2 * audit.count("D") + 5 * audit.count("I") + audit.count("R") + sum(5 for e, c in zip(audit.replace("I", ""), codes, strict=True) if e != "D" and c & 7 == repair._CUT)


def test_reports_of_hard_conversations(spark, tmp_path):
    import hashlib

    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (1, 5, "user", "Hi."),
        (2, None, None, None), (3, 2, "tool", "x."), (3, 3, "", "ok? \n"), (None, 1, "user", "So?"), (None, 2, "assistant", "no end"),
        (4, 0, "system", "Be."), (4, 1, "user", " \x0b"), (5, 0, "user", "Gone."),
    ]
    table = frame(spark, tmp_path, rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(7) for c in ("place", "code", "audit", "same")})
    found = repair.repair(table.withColumn("gone", F.coalesce(F.col("conv_id") == 5, F.lit(False))))
    said = {r.conv_id: tuple(r)[1:] for r in repair.digest(found).collect()}

    def sha(*lines):
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()

    assert said[1] == (3, 0, 2, 0, 1, 4, "KKDD", sha("user:Hi.", "assistant:Yes!"))
    assert said[2] == (0, 1, 0, 0, 0, 2, "D", sha(""))
    assert said[3] == (0, 0, 0, 0, 1, 2, "RR", sha("user:x.", "assistant:ok? \n"))
    assert said[None] == (0, 0, 0, 1, 0, 4, "DD", sha(""))
    assert said[4] == (0, 1, 0, 0, 0, 4, "DD", sha(""))
    assert said[5] == (0, 0, 0, 0, 0, 0, "", sha(""))
    rows = [(r.conv_id, r.place, r.edit, r.role) for r in found.where("conv_id = 3 and place is not null").collect()]
    assert rows == [(3, 0, "R", "user"), (3, 1, "R", "assistant")]
    assert repair.digest(repair.repair(repair.damaged(table.where("false")))).isEmpty()


def test_lines_cut_alike_share_their_keys(spark, tmp_path):
    """A line of 330 characters had 26 keys, one for each difference of lengths; lengths that are cut alike share theirs."""
    rows = frame(spark, tmp_path, [(b"a", "".join(chr(97 + i * i % 23) for i in range(330)))], "lid binary, line string", "k")
    keys = line_dedup._keys(rows, line_dedup.THRESHOLD).collect()
    assert len(keys) == 12 and sum(k.role == 0 for k in keys) == 4


def test_counts_rule_out_pairs_of_crowded_lines(spark, tmp_path):
    """Lines of one bucket that differ by a word are not paired up, those within the edits are."""
    base = "the quick brown fox jumps over the lazy dog and runs into the forest again and again"
    lines = [base, base.replace("forest", "qqqqqqq"), base.replace("forest", "zzzzzz"), base.replace("forest", "foresty")]
    texts = frame(spark, tmp_path, [(bytes([i]), x) for i, x in enumerate(lines)], "lid binary, line string", "t")
    named = texts.selectExpr("1L AS bucket", "lid", "char_length(line) AS size", "0 AS role", "3 AS edits", "lid AS label")
    assert line_dedup._pairs(named).count() == 6
    assert {(bytes(x.a)[0], bytes(x.b)[0]) for x in line_dedup._crowded_pairs(named, texts).collect()} == {(0, 3), (1, 2)}
