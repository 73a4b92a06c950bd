"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Two lines match if few edits (of characters) turn one into the other: one for each started
`chars_an_edit` characters of the shorter line, `threshold` at most. A line with t edits is cut into
t + 1 segments; whatever the edits are, one segment of a matching line is free of
them and stands at a place that is off by a few characters at most. So each line is indexed by its
length and the text of each segment, and probes the index of its own and the next smaller lengths
with its substrings at the possible places: fewer edits than segments before it move a segment no further
than that, and the same holds for those behind it. Segments are cut for lengths that are rounded down, with a tail in none of them,
so that a line shares most keys of the lengths it probes for. Candidates of usual length first pass Spark's own distance with a
bound; what is left is cut to where it differs, and verified with a bit-parallel edit distance over a band of 2 * t + 1 diagonals.

Segments that very many lines share are not paired up: a line of each such bucket is compared with all
others that it is not connected with yet, in a few rounds. Lines of buckets that this leaves in several components
are cut finer, with all but t of the segments in the key. If such a bucket is still large for one edit, keys with a single
character left out tell the matches themselves, so each line is linked with one other only. For more edits
the rounds are repeated; what is in different components of one bucket after that is met pair by pair, where counts of
characters rule out most pairs before they are made.

Classes are the components of matching lines. The first line of each class, by document id and
place, stays and the others go.

Defined cases: lines of fewer than `least_chars` characters match equal lines only; their classes are told,
but `without_repeats` leaves them, as blank lines and brackets repeat in any text. Null
texts have no lines, an empty text has an empty one. Rows that repeat both id and text are one document; null ids stand behind no
id, in the order of a hash of their texts. Only the newline ends a line. A document that
loses all its lines goes in `without_repeats`. Extra columns stay.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import stored, unused
from bidmill.llm.components import components

#: Edits at most, and the characters of a line for each edit.
THRESHOLD = 3
CHARS_AN_EDIT = 40
LEAST_CHARS = 20
#: Lines of a bucket, times those that index it, up to which all its pairs are candidates.
SMALL = 400
#: Segments of the finer cut of crowded lines, by edits.
FINER = {1: 16, 2: 6, 3: 6}
#: Buckets up to which their hashes (8 bytes each) are sent to all tasks; more are met by shuffling the keys.
BROADCAST = 4_000_000
#: Rounds in which one line of a bucket is compared with all others.
ROUNDS = 2
#: Characters after which the verification of a pair may be abandoned.
PROBE = 24
#: Characters up to which whole lines are compared before they are trimmed, and those compared of longer ones once trimmed.
LONG = 512
PREFIX = 128
#: Groups of characters that are counted to rule out pairs of crowded lines; characters in none of them are not counted.
GROUPS = ("eE", "tT", "aA", "oO", "iI", "nN", "sS", "hH", "rR", "dDlL", "uUcCmM", "bBfFgGpPwWyY", "kKvVjJxXqQzZ", " .,", "0123456789")
#: Characters of a block of a line in which the way around crowded buckets looks for one edit.
BLOCK = 256

_INDEX = 1 << 32


def edits(length: Column, threshold: int = THRESHOLD, chars_an_edit: int = CHARS_AN_EDIT) -> Column:
    """Edits that a line of the length may have."""
    return F.least(F.lit(threshold), F.floor((length - 1) / chars_an_edit).cast("int") + 1)


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(missing, key, mark, no, line) of all lines."""
    return docs.select(*_doc_key(doc_id, text), F.posexplode(F.split(text, "\n")).alias("no", "line"))


def _doc_key(doc_id: str, text: str) -> list[Column]:
    key = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text))
    return [F.col(doc_id).isNull().alias("missing"), key.alias("key"), F.xxhash64(F.lit(1), F.col(text)).alias("mark")]


def _line_id() -> Column:
    return F.unhex(F.md5(F.col("line").cast("binary"))).alias("lid")


def _cut(length: Column) -> Column:
    """The length that segments are cut for: rounded down by an eighth at most, so that few lines probe for two of them."""
    step = F.pow(F.lit(2), F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)))) - 3, F.lit(0))).cast("int")
    return length - length % step


def _shapes(longer: range, t: int) -> Column:
    """(least difference of lengths, edits, number of the segment, how far it is moved) of the keys of lines that are so much
    longer than lines which index the same t + 1 segments."""
    moves = sorted({(i, moved) for n in longer for i in range(t + 1) for moved in range(max(-i, n - t + i), min(i, n + t - i) + 1)})
    return F.array(*[
        F.struct(F.lit(longer[0]).alias("longer"), F.lit(t).alias("edits"), F.lit(i).alias("i"), F.lit(moved).alias("moved"))
        for i, moved in moves
    ])


def _keys(lines: DataFrame, threshold: int) -> DataFrame:
    """(lid, size, role, edits, bucket) for each index and probe key of the lines (lid, line).

    Role 0 indexes a line by one of its segments; role 1 probes the index of as long and shorter lines.
    Lengths that are cut alike share their keys, with the moves of all of them.
    A row for each key comes first, so that one short expression makes them all: written out for each
    key, it is too long to be compiled. Segments of ASCII lines are cut as bytes, which needs no walk to their place.
    """
    size, line, shape = F.col("size"), F.col("line"), F.col("shape")
    cuts = F.col("cuts")
    own = []
    for t in range(1, threshold + 1):
        has = [edits(size - n, threshold) == t for n in range(t + 1)]
        alike = [F.lit(False), *[has[n - 1] & has[n] & (cuts[n - 1] == cuts[n]) for n in range(1, t + 1)], F.lit(False)]
        for first in range(t + 1):
            for last in range(first, t + 1):
                run = has[first] & ~alike[first] & ~alike[last + 1]
                for n in range(first + 1, last + 1):
                    run &= alike[n]
                own.append(F.when(run, _shapes(range(first, last + 1), t)))
    sized = lines.withColumns({"size": F.char_length("line"), "ascii": F.char_length("line") == F.octet_length("line")})
    sized = sized.withColumn("cuts", F.array(*[_cut(size - n) for n in range(threshold + 1)]))
    rows = sized.select("lid", "line", "size", "ascii", "cuts", F.explode(F.flatten(F.array_compact(F.array(*own)))).alias("shape"))
    rows = rows.withColumn("length", F.get(cuts, shape["longer"]))
    start, end = (F.floor((shape["i"] + k) * F.col("length") / (shape["edits"] + 1)).cast("int") + shape["moved"] for k in (0, 1))
    rows = rows.withColumns({"start": start, "end": end}).where("start >= 0 and end <= size")
    place, width = F.col("start") + 1, F.col("end") - F.col("start")
    segment = F.when(F.col("ascii"), F.substring(line.cast("binary"), place, width)).otherwise(F.substring(line, place, width).cast("binary"))
    role = ((shape["longer"] > 0) | (shape["moved"] != 0)).cast("int")
    return rows.select("lid", "size", role.alias("role"), shape["edits"].alias("edits"), F.xxhash64("length", shape["edits"], shape["i"], segment).alias("bucket"))


def _profiles(segments: int, threshold: int) -> list[tuple[int, int, list[int], list[int]]]:
    """(role, difference of lengths, segments that may hold edits, offsets of the runs between them).

    Role 0 indexes a line; role 1 probes the index with a line that is longer by the difference, or
    as long with runs that are moved.
    """
    out = []
    for free in combinations(range(segments), threshold):
        apart = [free[i] + 1 < free[i + 1] for i in range(threshold - 1)]
        inner = [range(-threshold, threshold + 1) if run else [0] for run in apart]
        for longer in range(threshold + 1):
            for moved in product(*inner):
                places = [0, *[m for m, run in zip(moved, apart) if run], longer]
                if sum(abs(b - a) for a, b in zip(places, places[1:])) <= threshold:
                    role = int(longer > 0 or any(moved))
                    out.append((role, longer, list(free), [0, *moved, longer]))
    return out


def _finer_keys(lines: DataFrame, most: int, threshold: int) -> DataFrame:
    """As `_keys`, for lines with `threshold` edits, with all segments of a finer cut but that many in each key.

    Lengths are not cut alike here, and moves are told by each difference of lengths.
    """
    segments = FINER.get(threshold, 2 * threshold)
    profiles = _profiles(segments, threshold)
    numbers = {tuple(free): i for i, free in enumerate(combinations(range(segments), threshold))}
    size, line = F.col("size"), F.col("line")

    def key(p: Column) -> Column:
        length = size - p["longer"]
        free, moved = p["free"], p["moved"]
        runs, fits = [], edits(length, most) == threshold
        for i in range(threshold + 1):
            start = F.floor((free[i - 1] + 1) * length / segments).cast("int") if i else F.lit(0)
            end = F.floor(free[i] * length / segments).cast("int") if i < threshold else length
            runs.append(F.substring(line, start + moved[i] + 1, end - start))
            if 0 < i < threshold:  # the others are aligned with the ends of the line
                fits &= (start + moved[i] >= 0) & (end + moved[i] <= size)
        return F.struct(p["role"].alias("role"), F.lit(threshold).alias("edits"), F.when(fits, F.xxhash64(length, F.lit(segments), p["number"], *runs)).alias("bucket"))

    literal = F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(longer).alias("longer"), F.lit(numbers[tuple(free)]).alias("number"),
                 F.array(*map(F.lit, free)).alias("free"), F.array(*map(F.lit, moved)).alias("moved"))
        for role, longer, free, moved in profiles
    ])
    keyed = lines.withColumn("size", F.char_length("line")).select("lid", "size", F.explode(F.transform(literal, key)).alias("k"))
    return keyed.select("lid", "size", "k.role", "k.edits", "k.bucket").where("bucket is not null")


def _members(keys: DataFrame) -> DataFrame:
    """The keys in buckets of several that hold an index key, for keys of different lines."""
    spark = keys.sparkSession
    # One number a bucket, so that the shuffle of all keys stays small.
    sums = keys.groupBy("bucket").agg(F.sum(F.when(F.col("role") == 0, F.lit(_INDEX + 1)).otherwise(F.lit(1))).alias("n"))
    live = stored(spark, sums.where((F.col("n") >= _INDEX) & (F.col("n") % _INDEX > 1)).select(F.col("bucket").alias("_b")), "live")
    # The keys are many more than those that meet, so they are not shuffled again while that can be had.
    few = F.broadcast(live) if live.count() <= BROADCAST else live
    met = keys.join(few, F.col("bucket") == F.col("_b")).select("bucket", "lid", "size", "role", "edits")
    return stored(spark, met.distinct(), "members")


def _pairs(named: DataFrame) -> DataFrame:
    """Pairs (a, b) of different labels in one bucket, one of them by an index key."""
    return _met(named).distinct()


def _met(named: DataFrame, *more: Column) -> DataFrame:
    a, b = named.where("role = 0").alias("a"), named.alias("b")
    met = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.label") != F.col("b.label")) & ((F.col("b.role") == 1) | (F.col("a.lid") < F.col("b.lid")))
    met &= F.abs(F.col("a.size") - F.col("b.size")) <= F.col("a.edits")
    for condition in more:
        met &= condition
    return a.join(b, met).select(F.least("a.lid", "b.lid").alias("a"), F.greatest("a.lid", "b.lid").alias("b"))


def _counts(line: Column) -> Column:
    """How many characters of each group a line has, one column a group."""
    return F.struct(*[(F.char_length(line) - F.char_length(F.translate(line, g, ""))).alias(f"n{i}") for i, g in enumerate(GROUPS)])


def _apart() -> Column:
    """Differences of the counts of lines a and b; one edit takes a character from one group and gives one to another at most."""
    return sum((F.abs(F.col(f"a.counts.n{i}") - F.col(f"b.counts.n{i}")) for i in range(len(GROUPS))), F.lit(0))


def _crowded_pairs(named: DataFrame, texts: DataFrame) -> DataFrame:
    """As `_pairs`, for lines that share most of their text: the counts of their characters rule out most pairs as they meet."""
    counts = texts.select(F.col("lid").alias("_l"), _counts(F.col("line")).alias("counts"))
    whole = named.join(counts, F.col("lid") == F.col("_l")).drop("_l")
    return _met(stored(named.sparkSession, whole, "counted"), _apart() <= 2 * F.col("a.edits")).distinct()


def _bounded(x: Column, y: Column, most: Column, threshold: int) -> Column:
    """Whether so many edits are enough, `threshold` at most; the compiled function gives -1 above that."""
    return F.pmod(F.levenshtein(x, y, threshold), F.lit(threshold + 2)) <= most


def _split(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the small buckets, and of the large ones."""
    spark = members.sparkSession
    sizes = members.groupBy("bucket").agg(F.sum(F.expr("int(role = 0)")).alias("index"), F.count("*").alias("all"))
    sized = members.join(stored(spark, sizes.withColumn("large", F.col("index") * F.col("all") > SMALL), "sizes"), "bucket")
    return tuple(sized.where(c).select(*members.columns) for c in ("not large", "large"))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members with the components that links (a, b) give them."""
    labels = stored(members.sparkSession, components(links), "labels")
    met = members.join(labels, F.col("lid") == F.col("node"), "left")
    return met.select(*members.columns, F.coalesce("component", "lid").alias("label"))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of lines that match; `texts` holds each line (lid, line) once."""
    spark = pairs.sparkSession
    one = pairs.join(texts.select(F.col("lid").alias("a"), F.col("line").alias("x")), "a")
    two = one.join(texts.select(F.col("lid").alias("b"), F.col("line").alias("y")), "b")
    m, n = F.char_length("x"), F.char_length("y")
    near = two.withColumn("edits", edits(F.least(m, n), threshold)).where(F.abs(m - n) <= F.col("edits"))
    # Most pairs do not match: they go by a compiled function, and the steps below see few. It takes the square of a line's
    # length, so of longer lines only the first characters that differ are looked at: prefixes differ by twice the edits at most.
    x, y = F.col("x"), F.col("y")
    near = stored(spark, near.where((F.greatest(m, n) > LONG) | _bounded(x, y, F.col("edits"), threshold)), "near")
    rest = stored(spark, _rest(near), "trimmed")  # written out, or the condition would repeat all its steps
    rest = rest.where(_bounded(F.substring(x, 1, PREFIX), F.substring(y, 1, PREFIX), 2 * F.col("edits"), 2 * threshold))
    longer = F.char_length("x") >= F.char_length("y")
    long, short = F.when(longer, F.col("x")).otherwise(F.col("y")), F.when(longer, F.col("y")).otherwise(F.col("x"))
    # Written out, so that each step of the verification finds the characters ready.
    rest = stored(spark, rest.select("a", "b", "edits", _characters(long).alias("x"), _characters(short).alias("y")), "rest")
    match = F.lit(False)
    for t in range(threshold, 0, -1):
        match = F.when(F.col("edits") == t, within(F.col("x"), F.col("y"), t)).otherwise(match)
    return rest.where(match).select("a", "b")


def _by_centres(members: DataFrame, links: DataFrame, texts: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """More links, and the labelled members of buckets that they do not connect.

    Each round compares one line of a bucket, first of all that with the most buckets, with all that it is not
    connected with: the base of many near copies shares more segments with them than they do with each other.
    """
    spark = members.sparkSession
    degrees = stored(spark, members.groupBy(F.col("lid").alias("_l")).agg(F.count("*").alias("degree")), "degrees")
    members = stored(spark, members.join(degrees, F.col("lid") == F.col("_l")).drop("_l"), "members")
    for n in range(ROUNDS + 1):
        named = stored(spark, _labelled(members, links), "named")
        order = F.struct(F.col("label") == F.col("lid"), F.col("degree"), F.xxhash64("lid", F.lit(n)))
        centre = F.max_by(F.struct(F.col("lid").alias("c"), F.col("label").alias("l")), order)
        mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), centre.alias("centre"))
        mixed = stored(spark, mixed.where("low <> high").select(F.col("bucket").alias("_b"), "centre"), "mixed")
        met = named.join(mixed, F.col("bucket") == F.col("_b"))
        members = stored(spark, met.select(*members.columns, "label", "centre"), "members")
        if n == ROUNDS or members.isEmpty():
            return links, members.drop("degree", "centre")
        other = members.where("label <> centre.l")
        pairs = other.select(F.least("lid", "centre.c").alias("a"), F.greatest("lid", "centre.c").alias("b"))
        links = stored(spark, links.unionAll(_verified(stored(spark, pairs.distinct(), "pairs"), texts, threshold)), "links")
        members = members.drop("label", "centre")


def _one_edit(lines: DataFrame) -> DataFrame:
    """Links (a, b) of lines that one edit turns into each other, each line with one other of a group.

    Lines that are equal without the character at one place match all of each other; a line without
    one of its characters may be another line.
    """
    spark = lines.sparkSession
    line = F.col("line")
    size = F.char_length(line)

    def digest(*parts: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws(" ", *parts).cast("binary")))

    def blocks(size: Column, width: int) -> DataFrame:
        """The blocks of the lines at multiples of BLOCK, and what stands before and after each."""
        row = lines.where(size > 0).select("lid", "line", size.alias("size"), F.explode(F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int"))).alias("block"))
        start = F.col("block") * BLOCK
        before, after = F.md5(F.substring(line, F.lit(1), start).cast("binary")), F.md5(F.substring(line, start + width + 1, F.char_length(line)).cast("binary"))
        return row.select("lid", F.concat_ws(" ", "size", "block", before, after).alias("around"), F.substring(line, start + 1, F.lit(width)).alias("middle"))

    # A row for each place, with a key of one block's length, so that memory does not grow with the square of a line.
    left = blocks(size, BLOCK).select("lid", "around", "middle", F.explode(F.sequence(F.lit(1), F.char_length("middle"))).alias("no"))
    middle, no = F.col("middle"), F.col("no")
    rest = F.concat(F.substring(middle, F.lit(1), no - 1), F.substring(middle, no + 1, F.char_length(middle)))
    left = left.select("lid", digest(no.cast("string"), F.col("around"), rest).alias("group"), digest(F.col("around"), rest).alias("shorter"))
    left = stored(spark, left, "changed")
    least = left.groupBy("group").agg(F.min("lid").alias("a"), F.max("lid").alias("high")).where("a <> high").drop("high")
    same = left.join(stored(spark, least, "least"), "group").where("a <> lid").select("a", F.col("lid").alias("b"))
    # As if each line had one character more, which is missing in the block.
    whole = blocks(size + 1, BLOCK - 1).select(F.col("lid").alias("a"), digest(F.col("around"), F.col("middle")).alias("shorter"))
    found = left.select("lid", "shorter").distinct().join(stored(spark, whole, "whole"), "shorter").select("a", F.col("lid").alias("b"))
    return same.unionAll(found).distinct()


def _rest(pairs: DataFrame) -> DataFrame:
    """The lines x and y without their common first and last characters."""
    rows = pairs
    for _ in ("front", "back"):
        rows = rows.withColumn("common", _common(F.col("x"), F.col("y")))
        cut = {name: F.reverse(F.substring(F.col(name), F.col("common") + 1, F.char_length(name))) for name in ("x", "y")}
        rows = rows.withColumns(cut).drop("common")
    return rows


def _characters(text: Column) -> Column:
    return F.when(F.char_length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def _common(x: Column, y: Column) -> Column:
    """How many first characters are equal, by halving steps."""
    length = F.least(F.char_length(x), F.char_length(y))

    def longer(n: Column, step: Column) -> Column:
        more = (step <= length - n) & (F.substring(x, n + 1, step) == F.substring(y, n + 1, step))
        return F.when(more, n + step).otherwise(n)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), F.lit(0), longer)


def within(rows: Column, columns: Column, threshold: int) -> Column:
    """Whether the edit distance of two arrays of characters is at most the threshold: bit-parallel, in a band.

    The first array is the longer one. Both should be plain columns, as each step looks them up.
    Bit k of the vectors stands for the row that is k - threshold under the diagonal. The distance
    is followed along the lowest diagonal of the band to the last row, then along that row.

    Pairs that differ by far are abandoned after PROBE columns: a path of at most `threshold` edits that stands k
    under the diagonal there, -threshold <= k, is threshold - k steps from the place that is followed, so the
    distance at that place is at most 3 * threshold.
    """
    band = 2 * threshold + 1
    full = (1 << band) - 1
    m, n = F.size(rows), F.size(columns)

    def step(s: Column, j: Column) -> Column:
        c = F.get(columns, j - 1)
        match = F.lit(0).cast("long")
        for k in range(band):
            at = j - threshold + k - 1
            match = match + F.when((at >= 0) & (F.get(rows, at) == c), F.lit(1 << k)).otherwise(0)
        return F.struct(match.alias("pm"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"), j.alias("j"))

    def down(s: Column) -> Column:
        """Diagonal zeros of the column."""
        d0 = (s["pm"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
        return d0.bitwiseOR(s["pm"]).bitwiseOR(s["vn"]).bitwiseAND(F.lit(full))

    def flip(v: Column) -> Column:
        return v.bitwiseXOR(F.lit(full).cast("long"))

    def advance(s: Column, j: Column) -> Column:
        def one(t: Column, _: Column) -> Column:
            d0, hp, hn = t["d0"], t["hp"], t["hn"]
            half = F.shiftrightunsigned(d0, 1)
            at = m - t["j"] + threshold  # the bit of the last row
            diagonal = 1 - F.shiftrightunsigned(d0, band - 1)
            along = F.getbit(hp, F.greatest(at, F.lit(0))).cast("long") - F.getbit(hn, F.greatest(at, F.lit(0))).cast("long")
            moved = F.when(t["j"] + threshold <= m, diagonal).otherwise(along)
            return F.struct(hn.bitwiseOR(flip(half.bitwiseOR(hp))).alias("vp"), half.bitwiseAND(hp).alias("vn"), (t["d"] + moved).alias("d"))

        one_step = step(s, j)
        # Nested transforms name each intermediate value once.
        with_d0 = F.transform(F.array(one_step), lambda t: F.struct(down(t).alias("d0"), t["vp"].alias("vp"), t["vn"].alias("vn"), t["d"].alias("d"), t["j"].alias("j")))
        with_h = F.transform(with_d0, lambda t: F.struct(
            t["d0"].alias("d0"), t["vn"].bitwiseOR(flip(t["d0"].bitwiseOR(t["vp"]))).alias("hp"), t["d0"].bitwiseAND(t["vp"]).alias("hn"), t["d"].alias("d"), t["j"].alias("j")))
        return F.transform(with_h, lambda t: one(t, t))[0]

    first = F.struct(F.lit(full & ~((1 << threshold) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(threshold).cast("long").alias("d"))

    def distance(upto: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), upto), first, advance, lambda s: s["d"])

    banded = F.when((n > PROBE) & (distance(F.lit(PROBE)) > 3 * threshold), False).otherwise(distance(n) <= threshold)
    far = F.abs(m - n) > threshold
    return F.when(far, False).when((m <= threshold) & (n <= threshold), True).when(n == 0, m <= threshold).otherwise(banded)


def matches(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Verified links (a, b) between different lines (lid, line), as many as the classes need."""
    spark = lines.sparkSession
    members = _members(_keys(lines, threshold))
    wanted = stored(spark, members.select("lid").distinct(), "wanted")
    # Met by shuffling at every size, so that the cost grows evenly.
    texts = stored(spark, lines.join(wanted.hint("merge"), "lid"), "texts")
    small, large = _split(members)
    pairs = stored(spark, _pairs(small.withColumn("label", F.col("lid"))), "pairs")
    links = stored(spark, _verified(pairs, texts, threshold), "links")
    large = stored(spark, large, "large")
    if large.isEmpty():
        return links
    found, large = _by_centres(large, links.where("false"), texts, threshold)
    if not large.isEmpty():
        found = _by_finer_keys(large, found, texts, threshold)
    return stored(spark, links.unionAll(found).distinct(), "links")


def _by_finer_keys(members: DataFrame, links: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Links that connect all matching lines of the buckets, given those so far."""
    spark = members.sparkSession
    finer = stored(spark, texts.join(members.select("lid", "edits").distinct(), "lid"), "finer")
    keys = None
    for t in range(1, threshold + 1):
        own = _finer_keys(finer.where(F.col("edits") == t).drop("edits"), threshold, t)
        keys = own if keys is None else keys.unionAll(own)
    small, large = _split(stored(spark, _labelled(_members(keys), links), "named"))
    pairs = stored(spark, _crowded_pairs(small, texts), "pairs")
    links = stored(spark, links.unionAll(_verified(pairs, texts, threshold)), "links")
    large = stored(spark, large.drop("label"), "large")
    one = texts.join(large.where("edits = 1").select("lid").distinct(), "lid")
    if not one.isEmpty():
        links = stored(spark, links.unionAll(_one_edit(one)), "links")
    large = large.where("edits > 1")
    if not large.isEmpty():
        links, large = _by_centres(large, links, texts, threshold)
        links = links.unionAll(_verified(stored(spark, _crowded_pairs(large, texts), "pairs"), texts, threshold))
    return links


def repeats(docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line: (missing, key, mark, no), `long` if it can go, and `first`, that of the first of its class.

    `first` is null for lines that occur once and match no other.
    """
    spark = docs.sparkSession
    lines = _lines(docs, doc_id, text)
    long = F.char_length("line") >= least_chars
    different = stored(spark, lines.where(long).select(_line_id(), "line").dropDuplicates(["lid"]), "different")
    classes = stored(spark, components(matches(different, threshold)), "classes")
    place = F.struct("missing", "key", "mark", "no")
    firsts = lines.groupBy(_line_id()).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    of_line = stored(spark, firsts.join(classes, F.col("lid") == F.col("node"), "left").where("component is not null or first <> last").select("lid", "component", "first"), "firsts")
    least = of_line.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    of_line = of_line.join(stored(spark, least, "least"), "component", "left").select(F.col("lid").alias("_l"), F.coalesce("least", "first").alias("first"))
    of_line = stored(spark, of_line, "firsts")
    placed = lines.select("missing", "key", "mark", "no", long.alias("long"), _line_id())
    return placed.join(of_line, F.col("lid") == F.col("_l"), "left").drop("lid", "_l")


def _goes() -> Column:
    return F.col("long") & F.coalesce(F.col("first") != F.struct("missing", "key", "mark", "no"), F.lit(False))


def digest(found: DataFrame) -> DataFrame:
    """A row for each line, with the place of the first line of its class, and whether it stays."""
    def own(key: str, missing: str) -> Column:
        return F.when(~F.col(missing), F.col(key))

    first = F.coalesce("first", F.struct("missing", "key", "mark", "no"))
    named = found.withColumn("kept", ~_goes()).withColumn("first", first)
    return named.select(
        own("key", "missing").alias("doc_id"), F.col("no").alias("line_no"), own("first.key", "first.missing").alias("class_doc_id"),
        F.col("first.no").alias("class_line_no"), "kept",
    )


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents with their remaining lines; n_chars, if there is one, is counted anew."""
    spark = docs.sparkSession
    found = repeats(docs, threshold, least_chars).where(_goes())
    gone = found.groupBy("key", "mark").agg(F.collect_set("no").alias("_gone"))  # lines of one document
    key, mark, k, m, out = (unused(docs, n) for n in ("key", "mark", "_k", "_m", "_gone"))
    gone = stored(spark, gone.select(F.col("key").alias(k), F.col("mark").alias(m), F.col("_gone").alias(out)), "gone")
    _, key_of, mark_of = _doc_key("doc_id", "text")
    met = docs.select("*", key_of.alias(key), mark_of.alias(mark)).join(gone, (F.col(key) == F.col(k)) & (F.col(mark) == F.col(m)), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, no: ~F.array_contains(out, no))
    new = F.when(F.col(out).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    met = met.where(F.col(out).isNull() | (F.size(out) < F.size(lines)))
    columns = [new.alias("text") if c == "text" else F.char_length(new).cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns]
    return met.select(columns)
