"""Near-duplicate documents by MinHash, banding, verification and connected components.

Each document is the set of its distinct word shingles. Documents with equal sets are one node from
the start. HASHES universal hash functions give a signature of minima; documents that agree on all
ROWS minima of a band share a bucket. Components come from alternating large-star and small-star.

No bucket emits its pairs. First each bucket's members are compared with one central member, that which
shares the most with others; this joins nearly all of a large group. Where a bucket still holds several
components, its members that are not in the centre's component are compared with all others, block by block in
tasks of a bounded size, and only links come out, at most one for each member. For that a member needs only
its difference from the centre: two sets differ by just what their differences from a third set
differ by. So comparing is exact, every pair of a bucket is in one component already or compared, and
rows grow with the members. Signatures are verified on the way to a comparison with a centre: a pair whose minima
agree too rarely (seven standard deviations under the threshold) is no link.

With 24 bands of 4 rows a pair of similarity 0.85 shares no band with probability 2e-8, one of 0.8 with 3e-6.
The signatures rule such a pair out with probability 3e-10 and 5e-11 under its own threshold, so bands rule the sum.
Words are hashed by BLAKE2b and shingles by sums over odd multipliers modulo 2**64.

Defined cases: null text, and text without words, is an empty set, linked with nothing. A text of
fewer words than a shingle is one shingle. Null ids: such documents are linked by their text like
others, but a component's id is its smallest id that is not null, null if there is none. Rows may
repeat. No documents give no rows. Texts of any length are taken whole.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import LOWER, as_bytes, mixed, stored, unused, word_lists
from bidmill.llm.components import components

HASHES = 96
ROWS = 4
_BANDS = HASHES // ROWS
#: Words that a Python process remembers with their hashes, none of them longer than so many bytes.
_REMEMBERED = 1 << 20
_REMEMBERED_BYTES = 64
#: Members of a centre that one task compares with it, and members and shingles of a block of a bucket.
_OF_CENTRE = 512
_BLOCK = 1024
_BLOCK_SHINGLES = 1 << 19
#: Shingles of a block that are looked at together.
_COLUMNS = 4096
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_WORD_PLACES = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        own = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= _REMEMBERED_BYTES:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = own
        return own


_WORDS = _Words()


def _word_hashes(text: str | None, known: _Words) -> np.ndarray:
    parts = [np.fromiter(map(known.__getitem__, own), np.uint64, len(own)) for own in word_lists(as_bytes(text).translate(LOWER))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    known, out = _WORDS, []
    for text in texts:
        hashes = _word_hashes(text, known)
        n = len(hashes)
        if n >= words:
            rolled = np.zeros(n - words + 1, np.uint64)
            for k in range(words):
                rolled += hashes[k : k + len(rolled)] * _WORD_PLACES[k % 64]
            out.append(np.unique(mixed(rolled)))
        elif n:
            short = (hashes * _WORD_PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mixed(np.array([short])))
        else:
            out.append(hashes)
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of each set that isn't empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):
        upto, size = at + 1, len(sets[at])
        while upto < len(sets) and size + len(sets[upto]) <= 1 << 15:
            size += len(sets[upto])
            upto += 1
        values = np.concatenate(sets[at:upto])
        cuts = np.cumsum([0, *(len(s) for s in sets[at : upto - 1])])
        hashed = np.empty_like(values)
        for k in range(HASHES):
            np.multiply(values, _A[k], out=hashed)
            np.add(hashed, _B[k], out=hashed)
            out[at:upto, k] = np.minimum.reduceat(hashed, cuts) >> np.uint64(32)
        at = upto
    return out


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, key, mark, n_shingles, node, bands, sketch) of docs (id, key, mark, text)."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = shingle_sets(batch.column(3).to_pylist(), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                signature = minima([sets[i] for i in full])
                bands = np.full((len(full), _BANDS), np.uint64(0x9E3779B97F4A7C15)) * np.arange(1, _BANDS + 1, dtype=np.uint64)
                for k in range(ROWS):
                    bands = mixed(bands ^ signature[:, k::ROWS].astype(np.uint64) + np.uint64(k))
                sketch = (signature & 0xFF).astype(np.uint8).view(np.int64)
                nodes = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                arrays = [pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary())]
                arrays += [_spread(m, full, len(sets)) for m in (bands.view(np.int64), sketch)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], ["id", "key", "mark", "n_shingles", "node", "bands", "sketch"])

    return docs.mapInArrow(run, "id long, key long, mark long, n_shingles long, node binary, bands array<long>, sketch array<long>")


def _spread(rows: np.ndarray, places: list[int], n: int) -> pa.Array:
    """A list for each of n rows, null but at the given places."""
    sizes = np.zeros(n, np.int32)
    sizes[places] = rows.shape[1]
    missing = np.ones(n, bool)
    missing[places] = False
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()), mask=pa.array(missing))


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the minima agree in their last byte."""
    return int((a.view(np.uint8) == b.view(np.uint8)).sum())


class _Rule:
    """Linked if 100 * intersection >= percent * union, of shingles of so many words."""

    def __init__(self, percent: int, words: int):
        self.percent, self.words = percent, words
        t = percent / 100
        self.least = int(np.floor(HASHES * t - 7 * np.sqrt(HASHES * t * (1 - t))))

    def linked(self, n, m, both):
        return both * 100 >= (n + m - both) * self.percent


class _Lists:
    """Rows of a list column of numbers, without a Python object for each number."""

    def __init__(self, column: pa.ListArray):
        self.offsets = column.offsets.to_numpy()
        self.values = column.values.to_numpy(zero_copy_only=False)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.offsets[i] : self.offsets[i + 1]]


def _list_column(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *rows])))


_COMPARED = "a binary, b binary, n int, linked boolean, differs array<long>"


def _with_centres(star: DataFrame, sets: DataFrame, rule: _Rule) -> DataFrame:
    """(a, b, n, linked, differs) for each pair (a, b): a's size, and in what a and its centre b differ.

    A centre's set goes once to each of the tasks that its members are dealt to.
    """
    spark = star.sparkSession
    loads = star.groupBy("b").agg(F.ceil(F.count("*") / _OF_CENTRE).cast("int").alias("parts"))
    loads = stored(spark, loads, "loads")
    part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    members = star.join(loads, "b").select("a", "b", part).join(sets.withColumnRenamed("node", "a"), "a")
    centres = loads.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    centres = centres.join(sets.withColumnRenamed("node", "b"), "b").withColumn("a", F.lit(None).cast("binary"))
    columns = ["b", "part", "a", "shingles", "sketch"]
    dealt = members.select(columns).unionAll(centres.select(columns))
    dealt = dealt.repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())

    def run(batches):
        centre, minima_ = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                nodes, centres = batch.column(2).to_pylist(), batch.column(0).to_pylist()
                shingles, sketches = _Lists(batch.column(3)), _Lists(batch.column(4))
                out = []
                for i, node in enumerate(nodes):
                    own = shingles[i]
                    if node is None:
                        centre, minima_ = own.copy(), sketches[i].copy()
                        continue
                    differs = np.setxor1d(own, centre, assume_unique=True)
                    both = (len(own) + len(centre) - len(differs)) // 2
                    linked = _agreeing(sketches[i], minima_) >= rule.least and rule.linked(len(own), len(centre), both)
                    out.append((node, centres[i], len(own), linked, differs))
                a, b, n, linked, differs = zip(*out, strict=True) if out else [()] * 5
                arrays = [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int32()), pa.array(linked, pa.bool_()), _list_column(list(differs))]
                yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "n", "linked", "differs"])

    return dealt.mapInArrow(run, _COMPARED)


def shared_counts(asking: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many numbers each of some sets shares with each of others; blocks of numbers at a time."""
    out = np.zeros((len(asking), len(others)), np.float32)
    flat = [np.concatenate([np.zeros(0, np.int64), *sets]) for sets in (asking, others)]
    owner = [np.repeat(np.arange(len(sets)), [len(s) for s in sets]) for sets in (asking, others)]
    common = np.intersect1d(*flat)
    at = [np.searchsorted(common, values) for values in flat]
    known = [np.flatnonzero(np.append(common, 0)[place] == values) if len(common) else place[:0] for place, values in zip(at, flat, strict=True)]
    for low in range(0, len(common), _COLUMNS):
        tables = []
        for k, sets in enumerate((asking, others)):
            rows, columns = owner[k][known[k]], at[k][known[k]]
            inside = (columns >= low) & (columns < low + _COLUMNS)
            table = np.zeros((len(sets), min(_COLUMNS, len(common) - low)), np.float32)
            table[rows[inside], columns[inside] - low] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out.astype(np.int64)


def _cross_links(asking: list[tuple], others: list[tuple], rule: _Rule) -> list[tuple[bytes, bytes]]:
    """Links of rows (node, component, n, differs), one for each node that is joined by them."""
    if not asking or not others:
        return []
    n, m = (np.array([r[2] for r in rows]) for rows in (asking, others))
    e, f = (np.array([len(r[3]) for r in rows]) for rows in (asking, others))
    differ = e[:, None] + f - 2 * shared_counts([r[3] for r in asking], [r[3] for r in others])
    near = rule.linked(n[:, None], m, (n[:, None] + m - differ) // 2)
    top: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while top.setdefault(x, x) != x:
            x = top[x] = top[top[x]]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        a, b = asking[i], others[j]
        if a[1] != b[1] and (x := find(a[1])) != (y := find(b[1])):
            top[max(x, y)] = min(x, y)
            out.append((a[0], b[0]))
    return out


def _still_apart(shared: DataFrame, centres: DataFrame, groups: DataFrame, compared: DataFrame, rule: _Rule) -> DataFrame:
    """Links (a, b) between members of one bucket that are not yet in one component."""
    spark = shared.sparkSession
    placed = shared.join(groups, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    placed = stored(spark, placed, "placed")
    several = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    named = centres.join(several, "bucket").join(groups.select(F.col("node").alias("centre"), "component"), "centre", "left")
    named = stored(spark, named.select("bucket", "centre", F.coalesce("component", "centre").alias("home")), "open")
    inside = placed.join(named, "bucket").withColumn("outside", F.col("component") != F.col("home"))
    differs = compared.select(F.col("a").alias("node"), F.col("b").alias("centre"), "n", "differs")
    inside = inside.select("bucket", "node", "component", "centre", "outside").join(differs, ["node", "centre"])
    inside = stored(spark, inside.drop("centre"), "inside")
    weight = F.size("differs") + 1

    def blocks(count, load):
        return F.greatest(F.lit(1), F.ceil(count / _BLOCK), F.ceil(load / _BLOCK_SHINGLES)).cast("int")

    loads = inside.groupBy("bucket").agg(
        blocks(F.count("*"), F.sum(weight)).alias("others"),
        blocks(F.count_if("outside"), F.sum(F.when(F.col("outside"), weight))).alias("askers"),
    )
    met = inside.join(stored(spark, loads, "loads"), "bucket")

    def dealt(rows: DataFrame, asks: bool, own: str, each: str) -> DataFrame:
        """Each row in its own block of one kind, with all blocks of the other kind."""
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(each) - 1)).alias(each)
        return rows.select("bucket", mine, every, F.lit(asks).alias("asks"), "node", "component", "n", "differs")

    columns = ["bucket", "askers", "others", "asks", "node", "component", "n", "differs"]
    asking = dealt(met.where("outside"), True, "askers", "others").select(columns)
    rows = asking.unionAll(dealt(met, False, "others", "askers").select(columns))
    rows = rows.repartition("bucket", "askers", "others").sortWithinPartitions("bucket", "askers", "others")

    def run(batches):
        held, block = ([], []), None
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                names = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
                asks, nodes, components_, n = (batch.column(i).to_pylist() for i in range(3, 7))
                lists, out = _Lists(batch.column(7)), []
                for i, name in enumerate(names):
                    if name != block:
                        out += _cross_links(*held, rule)
                        held, block = ([], []), name
                    held[not asks[i]].append((nodes[i], components_[i], n[i], lists[i].copy()))
                yield _pairs(out)
        yield _pairs(_cross_links(*held, rule))

    return rows.mapInArrow(run, "a binary, b binary")


def _pairs(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in range(2)], ["a", "b"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, mark, n_shingles, component_id, component_key) for each document.

    key is the id, or a hash of the text for null ids; mark is another hash of the text. component_key is
    the smallest id of the component, or its smallest key if it has no ids; component_id its smallest id.
    """
    spark, rule = docs.sparkSession, _Rule(percent, words)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), *_row_key(doc_id, text), F.col(text).alias("text"))
    signed = stored(spark, _signed(rows, words), "signatures")
    node_keys = signed.where("node is not null").groupBy("node").agg(F.min("key").alias("key"), F.min("id").alias("id"))
    node_keys = stored(spark, node_keys, "nodes")
    # One row of each node has its smallest key, or several equal rows do.
    nodes = signed.where("node is not null").select("node", "key", "sketch", "bands")
    lone = nodes.join(node_keys.select("node", "key"), ["node", "key"]).dropDuplicates(["node"])
    lone = stored(spark, lone, "nodes")
    keys = lone.select("node", F.explode("bands").alias("bucket"))
    buckets = stored(spark, keys.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    shared = stored(spark, keys.join(buckets, "bucket"), "shared")
    known = stored(spark, shared.groupBy("node").agg(F.sum("size").alias("weight")), "known")
    wanted = lone.join(known, "node").select("node", "key", "sketch")
    sets = stored(spark, _full_sets(rows, wanted, words), "sets")

    # Every bucket against its most connected member.
    weighted = shared.join(known, "node")
    centres = weighted.groupBy("bucket").agg(F.max(F.struct("weight", "node"))["node"].alias("centre"))
    centres = stored(spark, centres, "centres")
    star = shared.join(centres, "bucket").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    compared = stored(spark, _with_centres(stored(spark, star, "stars"), sets, rule), "compared")
    found = compared.where("linked and a <> b").select("a", "b")
    groups = components(found)
    more = stored(spark, _still_apart(shared, centres, groups, compared, rule), "found")
    if not more.isEmpty():
        groups = components(found.unionAll(more))

    groups = stored(spark, groups, "groups")
    of_node = node_keys.join(groups, "node", "left").select("node", "key", "id", F.coalesce("component", "node").alias("component"))
    least = of_node.groupBy("component").agg(F.min("id").alias("component_id"), F.coalesce(F.min("id"), F.min("key")).alias("component_key"))
    of_node = stored(spark, of_node.join(least, "component").select("node", "component_id", "component_key"), "classes")
    done = signed.select("id", "key", "mark", "n_shingles", "node").join(of_node, "node", "left")
    alone = F.col("node").isNull()
    return done.select(
        "id", "key", "mark", "n_shingles", F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("key")).otherwise(F.col("component_key")).alias("component_key"), alone.alias("alone"),
    )


def _row_key(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)).alias("key"), F.xxhash64(text, F.lit(1)).alias("mark")]


def _full_sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, sketch, shingles) of the wanted (node, key, sketch), from the whole texts.

    Rows can share a key without sharing a text; only those with the wanted set count.
    """

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sets = shingle_sets(batch.column(2).to_pylist(), words)
                names = batch.column(0).to_pylist()
                right = [i for i, s in enumerate(sets) if blake2b(s.tobytes(), digest_size=16).digest() == bytes(names[i])]
                kept = batch.take(pa.array(right, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns[:2], _list_column([sets[i].view(np.int64) for i in right])], ["node", "sketch", "shingles"])

    met = rows.select("key", "text").join(wanted, "key").select("node", "sketch", "text")
    return met.mapInArrow(run, "node binary, sketch array<long>, shingles array<long>").dropDuplicates(["node"])


def digest(found: DataFrame) -> DataFrame:
    """A row for each document with its component and whether it stays."""
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, one of each group of near duplicates: that with the smallest id.

    Documents without words all stay. Of rows that repeat both id and text one stays.
    """
    spark = docs.sparkSession
    found = near_duplicates(docs, words, percent)
    stay = found.where("alone or key = component_key").groupBy("key", "mark", "alone").agg(F.count("*").alias("n"), F.first("component_key").alias("group"))
    # Rows can share the smallest key without sharing the text.
    stay = stay.groupBy("group", "alone").agg(F.min(F.struct("mark", "key", "n")).alias("one")).select("one.*", "alone")
    stay = stored(spark, stay, "stay")
    key, mark, k, m, whole = (unused(docs, n) for n in ("key", "mark", "_k", "_m", "_all"))
    named = docs.select("*", _row_key("doc_id", "text")[0].alias(key), _row_key("doc_id", "text")[1].alias(mark))
    stay = stay.select(F.col("key").alias(k), F.col("mark").alias(m), (F.col("alone") | (F.col("n") == 1)).alias(whole))
    met = named.join(stay, (F.col(key) == F.col(k)) & F.col(mark).eqNullSafe(F.col(m)))
    once = met.where(F.col(whole)).select(docs.columns)
    if stay.where(~F.col(whole)).isEmpty():
        return once
    return once.unionAll(met.where(~F.col(whole)).dropDuplicates([key, mark]).select(docs.columns))
