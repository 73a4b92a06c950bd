"""Nulls, empty and repeated rows, empty tables, clashing names and hard inputs, on small tables."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidmill.llm import decontaminate, language_id, line_dedup, minhash, pieces, substrings, top_k, toxicity, url_lists, warc
from bidmill.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while the small cat watches from the old garden wall"


def frame(spark, tmp_path, rows, schema, name="t"):
    spark.createDataFrame(rows, schema).write.parquet(path := str(tmp_path / name))
    return spark.read.parquet(path)


def hard_documents(spark, tmp_path, rows=None):
    rows = rows if rows is not None else [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, None, None, None, None), (4, "", "en", "a", 0),
        (None, PROSE, "en", None, 1), (5, "x", "en", "a", 1), (5, "x", "en", "a", 1), (6, "\n \t\n", "en", "a", 4), (7, PROSE + " é 漢字 😀", "fr", "a", 9),
    ]
    return frame(spark, tmp_path, rows, DOCS)


def test_hard_documents_go_through_all_text_operators(spark, tmp_path):
    docs = hard_documents(spark, tmp_path)
    extra = docs.withColumns({c: F.lit(c) for c in ("key", "mark", "node", "ids", "runs", "score", "bits", "toxic", "_gone", "size")})
    labels = frame(spark, tmp_path, [(1, 1, 1), (2, 0, 0), (7, 1, 0), (None, 1, 1), (4, None, 1)], "doc_id long, quality int, toxic int", "l")
    items = frame(spark, tmp_path, [(1, "quick brown fox"), (None, "lazy dog"), (2, None), (3, " ")], "item_id long, text string", "b")
    for found in (docs, extra):
        said = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(found).select("doc_id", "lang_pred", "score").collect()}
        assert said[3] == said[4] == said[6] == ("und", 0.0)
        assert language_id.in_a_language(found).columns == found.columns
        near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.digest(minhash.near_duplicates(found, 3, 85)).collect()}
        n = len(PROSE.split()) - 2
        assert near[1, n] == (1, True) and near[2, n] == (1, False) and near[None, n] == (1, False)
        assert near[3, 0] == (3, True) and near[5, 1] == (5, True)
        kept = minhash.one_of_each(found)
        assert kept.columns == found.columns
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [1, 3, 4, 5, 6]
        hit = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.digest(decontaminate.find_passages(found, items)).collect()}
        assert hit[1] == (len(PROSE.split()), 5, 1) and hit[3] == hit[4] == (0, 0, 0)
        assert decontaminate.without_contaminated(found, items).columns == found.columns
        gone = {r.doc_id: r.n_removed for r in substrings.digest(substrings.repeated(found, length=20, piece=8)).collect()}
        assert gone[1] == gone[2] == gone[None] == len(PROSE) and gone[3] == gone[5] == 0
        first = {r.doc_id: r.n_removed for r in substrings.digest(substrings.repeated(found, length=20, piece=8, keep_first=True)).collect()}
        assert first[1] == 0 and first[2] == len(PROSE)
        lines = line_dedup.without_repeats(found)
        assert lines.columns == found.columns
        assert sorted(r.doc_id or 0 for r in lines.collect()) == [1, 3, 4, 5, 5, 6, 7]
        model = toxicity.learn(found, labels)
        assert toxicity.predict(found, model).count() == 9
        coded = {r.doc_id: (r.ids, r.n_tokens, r.round_trip) for r in pieces.encode(found).collect()}
        assert coded[3] == (None, 0, None) and coded[4] == ([], 0, True) and all(r[2] is not False for r in coded.values())


def test_empty_tables(spark, tmp_path):
    docs = hard_documents(spark, tmp_path, [])
    labels = frame(spark, tmp_path, [], "doc_id long, quality int, toxic int", "l")
    items = frame(spark, tmp_path, [], "item_id long, text string", "b")
    found = [
        language_id.identify(docs), minhash.near_duplicates(docs), minhash.one_of_each(docs), decontaminate.find_passages(docs, items),
        line_dedup.repeats(docs), line_dedup.without_repeats(docs), substrings.repeated(docs), pieces.encode(docs),
        toxicity.predict(docs, toxicity.learn(docs, labels)), components(docs.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))),
        top_k.search(docs.select(F.col("doc_id").alias("vec_id"), F.array("n_chars").alias("v")), F.col("vec_id") == 1),
    ]
    assert all(f.isEmpty() for f in found)


def test_embedded_magic_lines(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    html = [PROSE * 2, "x" + record + "y", "WARC/1.1\r\n", record * 3, "", None, PROSE * 2, "short", "short", "é" * 60, "\r\n\r\n" * 40]
    pages = frame(spark, tmp_path, [(i, f"http://h/{i}\r\nX: 1", h) for i, h in enumerate(html)] + [(None, None, PROSE * 2)], "page_id long, url string, html string", "p")
    warc.write_archives(pages, path := str(tmp_path / "archives"))
    rows = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    import hashlib

    assert len(rows) == len(html) + 1
    for i, h in enumerate(html):
        data = (h or "").encode()
        revisit = i == 6
        assert (rows[i].payload_bytes, rows[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (rows[i].record_type, rows[i].refers_to) == (("revisit", 0) if revisit else ("response", None))
    assert (rows[None].record_type, rows[None].refers_to) == ("revisit", 0)


def test_lists_hold_until_the_next_entry(spark, tmp_path):
    day = datetime.date
    entries = frame(spark, tmp_path, [("a.com", "block", day(2024, 1, 10)), ("a.com", "remove", day(2024, 3, 1)), ("x.a.com", "allow", day(2024, 2, 1)), ("x.a.com/p", "block", day(2024, 2, 20)), (None, "block", day(2024, 1, 1)), ("b.com", "what", day(2024, 1, 1)), ("a.com", "allow", day(2024, 1, 10))], "rule string, action string, listed_on date", "e")
    asked = [("http://a.com/", 9), ("http://a.com/", 10), ("https://X.a.com/p?q", 10), ("http://x.a.com/p", 35), ("http://x.a.com/p#f", 55), ("http://a.com", 61), (None, 20), ("nonsense", 20), ("http://b.com", None), ("http://ba.com/", 20)]
    start = day(2024, 1, 1) - datetime.timedelta(1)
    captures = frame(spark, tmp_path, [(u, n and start + datetime.timedelta(n), i) for i, (u, n) in enumerate(asked)], "url string, fetched_on date, rule long", "c")
    found = url_lists.judge(captures.withColumnRenamed("rule", "i"), entries)
    assert [r.blocked for r in found.orderBy("i").collect()] == [False, True, True, False, True, False, False, False, False, False]
    assert url_lists.judge(captures, entries.where("false")).where("blocked or rule is not null").isEmpty()


def test_top_k_against_all_scores(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=16) * (1 + i % 3), 2)]) for i in range(400)]
    rows += [(400, rows[3][1]), (401, None), (402, [float("nan")] * 16), (403, [None] + [1.0] * 15), (None, rows[0][1]), (500, [1.0, 2.0]), (100, rows[100][1])]
    vectors = frame(spark, tmp_path, rows, "vec_id long, embedding array<float>", "v").select("vec_id", top_k.whole_numbers(F.col("embedding")).alias("v"))
    found = sorted(tuple(r) for r in top_k.search(vectors, F.col("vec_id") % 100 == 0).collect())
    whole = [(r.vec_id, r.v) for r in vectors.where("v is not null and vec_id is not null").collect()]
    expected = []
    for q in (0, 100, 200, 300, 400):
        own = next(v for i, v in whole if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(own))
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:10], 1)]
    assert [f for f in found if f[0] != 500] == sorted(expected)


def test_large_near_group_is_exact(spark, tmp_path):
    r = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base = [r.choice(words) for _ in range(120)]
    texts = []
    for _ in range(150):
        own = list(base)
        for _ in range(r.randrange(8)):
            own[r.randrange(len(own))] = r.choice(words)
        texts.append(" ".join(own[: r.choice([120, 120, 120, 105])]))
    docs = frame(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string", "n")
    found = {x.doc_id: x.component_id for x in minhash.digest(minhash.near_duplicates(docs, 3, 85)).collect()}
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    assert found == {i: root(i) for i in range(len(sets))}


@pytest.mark.parametrize("crowded", [1, 1000])
def test_crowded_anchors_give_the_same(spark, tmp_path, monkeypatch, crowded):
    monkeypatch.setattr(substrings, "MOST", crowded)
    r = random.Random(2)
    shared = "".join(r.choice("abcdef") for _ in range(60))
    texts = ["".join(r.choice("abcdef") for _ in range(30)) + shared[r.randrange(10) :] + "".join(r.choice("abcdef") for _ in range(30)) for _ in range(40)] + ["ab" * 40, "a" * 50]
    docs = frame(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string", "s")
    found = {x.doc_id: x.n_removed for x in substrings.digest(substrings.repeated(docs, length=24, piece=10)).collect()}
    places = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - 23):
            places.setdefault(t[i : i + 24], []).append((d, i))
    gone = {d: set() for d in range(len(texts))}
    for where in places.values():
        for d, i in where if len(where) > 1 else ():
            gone[d] |= set(range(i, i + 24))
    assert found == {d: len(g) for d, g in gone.items()}


def test_streaming_search_equals_whole_search(spark):
    words = pieces.load()
    r = random.Random(4)
    for _ in range(20):
        text = "".join(r.choice(["▁", "the", "er", "é", "漢", "\n", "😀", "tion", "x", "▁▁"]) for _ in range(r.randrange(1, 120)))
        best, back = [0.0], [None]
        for end in range(1, len(text) + 1):
            spelt = text[end - 1].encode()
            options = [(best[b] + words.pieces[text[b:end]][1], -b, (words.pieces[text[b:end]][0],)) for b in range(max(0, end - words.longest), end) if text[b:end] in words.pieces]
            options.append((best[end - 1] + words.byte_score * len(spelt), -(end - 1), tuple(words.byte_ids[c] for c in spelt)))
            top = max(o[0] for o in options)
            choice = max((o for o in options if o[0] == top), key=lambda o: o[1])
            best.append(top)
            back.append((-choice[1], choice[2]))
        path, at = [], len(text)
        while at:
            at, own = back[at]
            path.append(own)
        assert list(pieces.search(text, words)) == [i for own in reversed(path) for i in own]


def test_edit_distance_in_a_band(spark, tmp_path):
    r = random.Random(3)
    pairs = []
    for _ in range(300):
        a = [r.choice("abé") for _ in range(r.randrange(14))]
        b = list(a)
        for _ in range(r.randrange(4)):
            k, i = r.randrange(3), r.randrange(len(b) + 1)
            b[i : i + (k > 0)] = [r.choice("abé")] if k < 2 else []
        pairs.append(tuple(sorted(("".join(a), "".join(b)), key=len, reverse=True)))
    df = frame(spark, tmp_path, pairs, "x string, y string", "d").select("x", "y", line_dedup._characters(F.col("x")).alias("a"), line_dedup._characters(F.col("y")).alias("b"))
    df.write.parquet(path := str(tmp_path / "chars"))
    df = spark.read.parquet(path)
    for n in (1, 2, 3):
        rows = df.select(line_dedup.within(F.col("a"), F.col("b"), n).alias("w"), (F.levenshtein("x", "y") <= n).alias("l")).collect()
        assert all(x.w == x.l for x in rows)


def test_edit_distance_of_pairs_that_may_be_abandoned(spark, tmp_path):
    """Edits massed before, at and behind the place where a pair may be abandoned, and pairs that differ by far."""
    r = random.Random(5)
    pairs = []
    for k in range(400):
        a = "".join(r.choices("ab" if k % 2 else "abcdefgh é", k=r.randrange(line_dedup.PROBE - 3, 3 * line_dedup.PROBE)))
        if k % 8 == 0:
            b = "".join(r.choices("abcdefgh é", k=len(a)))
        else:
            at = min(r.choice((1, line_dedup.PROBE - 4, line_dedup.PROBE + 4)), len(a) - 8)
            b = a[: at - 1] + edited(r, a[at - 1 : at + 7], r.randrange(5)) + a[at + 7 :]
        pairs.append(tuple(sorted((a, b), key=len, reverse=True)))
    pairs += [("xyz" + "abcd" * 20, "abcd" * 20), ("abcd" * 20 + "xyz", "abcd" * 20), ("xyz" + "abcd" * 20, "abcd" * 20 + "xyz")]
    df = frame(spark, tmp_path, pairs, "x string, y string", "d").select("x", "y", line_dedup._characters(F.col("x")).alias("a"), line_dedup._characters(F.col("y")).alias("b"))
    df.write.parquet(path := str(tmp_path / "chars"))
    df = spark.read.parquet(path)
    for n in (1, 2, 3):
        rows = df.select(line_dedup.within(F.col("a"), F.col("b"), n).alias("w"), (F.levenshtein("x", "y") <= n).alias("l")).collect()
        assert all(x.w == x.l for x in rows)
        assert any(x.w for x in rows) and not all(x.w for x in rows)


def test_words_longer_than_a_piece(monkeypatch):
    from bidmill.llm import common

    long = "".join(random.Random(7).choices("abcdefgh", k=5_000_000))
    one, same, other = minhash.shingle_sets([f"a {long} b c", f"a {long} b c d", f"a {long[:-1]}z b c"], 3)
    assert len(one) == 2 and len(same) == 3 and set(one) < set(same) and not set(one) & set(other)
    data = np.frombuffer(long[:9000].encode(), np.uint8)
    starts, ends = np.array([0, 5, 4000, 4001]), np.array([9, 8990, 4010, 9000])
    whole = common.span_hashes(data, starts, ends)
    monkeypatch.setattr(common, "_POWERS", 1 << 10)
    assert (common.span_hashes(data, starts, ends) == whole).all()


def test_languages_are_learned_behind_a_shared_opening(spark, tmp_path):
    r = random.Random(11)
    words = {lang: ["".join(r.choices(letters, k=r.randrange(3, 8))) for _ in range(60)] for lang, letters in (("aa", "abcdefghi"), ("bb", "efghijklm"))}
    opening = PROSE * 6
    texts = [(lang, " ".join(r.choices(words[lang], k=400))) for lang in sorted(words) for _ in range(40)]
    labelled = frame(spark, tmp_path, [(i, opening + " " + t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string", "o")
    bare = frame(spark, tmp_path, [(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string", "p")
    model = language_id.learn(labelled)
    assert all(r.lang == r.lang_pred for r in language_id.predict(bare, model).collect())
    sampled = labelled.select(language_id._sampled(F.col("text"), 400).alias("s"), "text").collect()
    assert all(sum(map(len, r.s)) == 400 and all(part in r.text for part in r.s) for r in sampled)


def test_crowded_lines_give_the_same_in_blocks(spark, tmp_path, monkeypatch):
    r = random.Random(9)
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    lines = {"".join(r.choices("ab\u00e9\U0001f600", k=33))}
    for _ in range(60):
        own = list(r.choice(sorted(lines)))
        k, i = r.randrange(3), r.randrange(len(own))
        own[i : i + (k > 0)] = [r.choice("abc ")] if k < 2 else []
        lines.add("".join(own))
    lines = sorted(lines | {"b", "ab", "a" * 8, "a" * 9, "a" * 16, "a" * 17})
    rows = frame(spark, tmp_path, [(x,) for x in lines], "line string", "c").select(line_dedup._line_id(), "line")
    links = line_dedup._one_edit(rows)
    text = {bytes(x.lid): x.line for x in rows.collect()}
    found = [(text[bytes(x.a)], text[bytes(x.b)]) for x in links.collect()]
    near = frame(spark, tmp_path, [(a, b) for a in lines for b in lines if a < b], "a string, b string", "n").where(F.levenshtein("a", "b") == 1)
    expected = {tuple(x) for x in near.collect()}
    assert {tuple(sorted(x)) for x in found} <= expected

    def classes(pairs):
        of = {x: {x} for x in lines}
        for a, b in pairs:
            if of[a] is not of[b]:
                of[a] |= of[b]
                for x in of[b]:
                    of[x] = of[a]
        return {frozenset(c) for c in of.values()}

    assert classes(found) == classes(expected)


def test_long_crowded_lines_are_linked(spark, tmp_path):
    r = random.Random(10)
    base = "".join(r.choices("abcdefgh", k=100_000))
    lines = [base[:50_000] + c + base[50_001:] for c in "ABCDEFGHIJKLMNOPQRSTUVWX"] + [base[:50_000] + base[50_001:]]
    docs = frame(spark, tmp_path, list(enumerate(lines)), "doc_id long, text string", "l")
    found = line_dedup.digest(line_dedup.repeats(docs)).collect()
    assert len(found) == 25 and all(x.class_doc_id == 0 for x in found) and sum(x.kept for x in found) == 1


def edited(r, line, n):
    for _ in range(n):
        k, i = r.randrange(3), r.randrange(len(line))
        line = line[:i] + ("", "\u00e9", "z" + line[i])[k] + line[i + 1 :]
    return line


def connected(lines, pairs):
    of = {x: {x} for x in lines}
    for a, b in pairs:
        if of[a] is not of[b]:
            of[a] |= of[b]
            for x in of[b]:
                of[x] = of[a]
    return {frozenset(c) for c in of.values()}


@pytest.mark.parametrize("small", [line_dedup.SMALL, 4])
def test_lines_of_several_edits_against_all_pairs(spark, tmp_path, monkeypatch, small):
    """Each number of edits, around the lengths where it changes, with small and with crowded buckets."""
    monkeypatch.setattr(line_dedup, "SMALL", small)
    r = random.Random(13)
    lines = {"a" * n for n in (30, 31, 60, 62, 90, 93)} | {"ab" * n for n in (20, 21, 41, 42, 60)}
    for size in (25, 39, 40, 41, 79, 80, 81, 83, 120):
        for _ in range(3):
            base = "".join(r.choices("abcde f", k=size))
            lines |= {base} | {edited(r, base, n) for n in (1, 1, 2, 2, 3, 3, 4)}
    lines = sorted(x for x in lines if len(x) >= 20)
    rows = frame(spark, tmp_path, [(x,) for x in lines], "line string", "c").select(line_dedup._line_id(), "line")
    text = {bytes(x.lid): x.line for x in rows.collect()}
    found = {tuple(sorted((text[bytes(x.a)], text[bytes(x.b)]))) for x in line_dedup.matches(rows).collect()}
    allowed = line_dedup.edits(F.least(F.char_length("a"), F.char_length("b")))
    pairs = frame(spark, tmp_path, [(a, b) for a in lines for b in lines if a < b], "a string, b string", "n")
    expected = {tuple(x) for x in pairs.where(F.levenshtein("a", "b") <= allowed).collect()}
    assert {line_dedup.THRESHOLD} <= {len(a) // 40 + 1 for a, _ in expected}
    assert found <= expected and connected(lines, found) == connected(lines, expected)
    if small > 4:
        assert found == expected


def test_near_lines_of_one_base_are_not_paired_up(spark, tmp_path, monkeypatch):
    """400 lines, each three edits away from a base: 79,800 pairs, of which few are compared."""
    r = random.Random(14)
    base = "".join(r.choices("abcdefgh ", k=160))
    lines = sorted({base} | {edited(r, base, 3) for _ in range(400)})
    compared, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    docs = frame(spark, tmp_path, list(enumerate(lines)), "doc_id long, text string", "d")
    found = line_dedup.digest(line_dedup.repeats(docs)).collect()
    assert len(found) == len(lines) and sum(x.kept for x in found) == 1
    assert sum(compared) < 4_000


def test_short_lines_are_reported_and_stay(spark, tmp_path):
    docs = frame(spark, tmp_path, [(1, "short line\n\n" + PROSE), (2, "short line\n\n" + PROSE + "!"), (3, ""), (4, "short lin")], "doc_id long, text string", "s")
    found = {(x.doc_id, x.line_no): (x.class_doc_id, x.class_line_no, x.kept) for x in line_dedup.digest(line_dedup.repeats(docs)).collect()}
    assert found == {
        (1, 0): (1, 0, True), (1, 1): (1, 1, True), (1, 2): (1, 2, True), (2, 0): (1, 0, True), (2, 1): (1, 1, True), (2, 2): (1, 2, False),
        (3, 0): (1, 1, True), (4, 0): (4, 0, True),
    }
    assert {(x.doc_id, x.text) for x in line_dedup.without_repeats(docs).collect()} == {(1, "short line\n\n" + PROSE), (2, "short line\n"), (3, ""), (4, "short lin")}


@pytest.mark.parametrize(("percent", "bands"), [(85, 2.1e-8), (80, 3.3e-6)])
def test_signatures_miss_less_than_bands(percent, bands):
    from math import comb

    t, least = percent / 100, minhash._Rule(percent, 3).least
    assert sum(comb(96, i) * t**i * (1 - t) ** (96 - i) for i in range(least)) < bands / 50
