"""Registered queries against SQL, or against brute force over whole small tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from bidmill.llm import oracle, queries
from bidmill.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def result(spark):
    """Rows of a query, as tuples in the order of its columns."""
    return lambda name: [tuple(r) for r in queries.queries()[name](spark, SF_DIR).collect()]


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_matches_sql(spark, database, name):
    found = queries.queries()[name](spark, SF_DIR)
    answer = database.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, found.select(names).collect()))) == sorted(map(repr, answer.fetchall()))


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("SELECT doc_id, text, lang FROM documents").fetchall()


def test_languages_of_held_out_documents(documents, result):
    lang = {d: name for d, _, name in documents}
    rows = result("op3_language_id")
    assert {r[0] for r in rows} == set(lang)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) and 0 <= r[3] <= 1 for r in rows)
    held = [r for r in rows if r[1]]
    assert sum(r[2] == lang[r[0]] for r in held) >= 0.97 * len(held)


def test_near_duplicates(documents, result):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()

    sets = {d: shingles(t) for d, t, _ in documents}
    parent = {d: d for d in sets}

    def root(d):
        return d if parent[d] == d else root(parent[d])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    expected = sorted((d, len(s), root(d), root(d) == d) for d, s in sets.items())
    assert sorted(result("op4_minhash")) == expected


def test_contaminated_documents(database, documents, result):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = collections.defaultdict(set)
    for item, text in database.execute("SELECT item_id, text FROM benchmark").fetchall():
        own = words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i : i + 10])].add(str(item))
    expected = []
    for doc, text, _ in documents:
        own, hit, items = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if found := windows.get(tuple(own[i : i + size])):
                    hit |= set(range(i, i + size))
                    items |= found
        expected.append((doc, len(own), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    assert sorted(result("op5_decontaminate")) == sorted(expected)


def test_repeated_substrings(documents, result):
    data = {d: (t or "").encode() for d, t, _ in documents}
    seen = collections.Counter(b[i : i + 200] for b in data.values() for i in range(len(b) - 199))
    expected = []
    for doc, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        expected.append((doc, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    assert sorted(result("op6_substrings")) == sorted(expected)


def test_pieces_decode_to_the_text(documents, result):
    rows = result("op10_pieces")
    assert len(rows) == len(documents)
    assert all(r[3] and r[2] == len(r[1]) for r in rows)


def test_toxic_documents(database, result):
    toxic = {r[0]: r[3] for r in result("op9_toxicity")}
    labels = database.execute("SELECT doc_id, toxic FROM labels").fetchall()
    assert sum(toxic[d] == bool(t) for d, t in labels) >= 0.9 * len(labels)


def test_lines(spark, documents, result):
    places = {}
    for doc, text, _ in sorted(documents):
        for no, line in enumerate(text.split("\n") if text is not None else []):
            places.setdefault(line, []).append((doc, no))
    parent = {line: line for line in places}

    def root(line):
        while parent[line] != line:
            line = parent[line]
        return line

    # Characters count, not bytes.
    lines = spark.createDataFrame([(line, len(line)) for line in places if len(line) >= 20], "line string, size int")
    a, b = lines.selectExpr("line AS a", "size AS m"), lines.selectExpr("line AS b", "size AS n")
    met = a.join(b, F.expr("n BETWEEN m AND m + 3 AND a <> b")).withColumn("most", F.expr("least(3, 1 + (m - 1) div 40)"))
    near = met.where("levenshtein(a, b, 3) BETWEEN 0 AND most").select("a", "b").collect()
    for a, b in near:
        x, y = sorted((root(a), root(b)), key=lambda z: places[z][0])
        parent[y] = x
    expected = [(*p, *places[root(line)][0], p == places[root(line)][0] or len(line) < 20) for line in places for p in places[line]]
    assert sorted(result("op2_line_dedup")) == sorted(expected)


def test_similar_fingerprints(documents, result):
    marks = {}
    for doc, text, _ in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        marks[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {d: d for d in marks}

    def root(d):
        return d if parent[d] == d else root(parent[d])

    for a in marks:
        for b in marks:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert sorted(result("op11_simhash")) == sorted((d, f"{m:016x}", root(d)) for d, m in marks.items())


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        docs = stored(spark, out, f"test-{name}")
        assert 0 < docs.count() <= n
        n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == n and last.where("not round_trip").isEmpty()
