"""Spelling variants by permuterm rotations.

Every rotation of a word with an end mark begins behind one of its characters, goes on past the mark
and ends in front of that character: all of it but the edited character is one prefix. Words that differ in
one replaced character share such a prefix of one rotation; a word without the character has the prefix as
a whole rotation. So after the rotations are brought together by that prefix, each group is scanned
once and gives each member its neighbours' number and best one. Of equal characters in a row only the
first counts as deletable, so no pair of words meets twice. A group holds one word for each character of the
alphabet and one without it, so its size is bounded by the alphabet and not by the data.

Words keep a number in code-point order, which stands for them in all joins. Prefixes of words over
LONG code points are replaced by hashes of both sides, so a word costs space in proportion to its length.

Forms are followed to their last word by doubling; a form occurs at least twice as often as its word, so
chains are short.

Defined cases: null texts have no words; a null doc_id hashes as empty text. Rows may repeat: each
counts. No documents give no rows. Texts of any length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import LOWER, stored

LEAST_CHARS = 5
LEAST_TIMES = 3
#: Code points of the longest prefix that is kept as text.
LONG = 64
_RUN = re.compile("[a-zÀ-ÿ]+")
_WHOLE, _FIRST, _LATER = range(3)
#: Characters of a text that are searched at once, and rows of a batch.
_PIECE = 1 << 20
_ROWS = 1 << 16


def _runs(text: str):
    """Lists of the maximal runs of a text's pieces, which end between runs."""
    at = 0
    while len(text) - at > _PIECE:
        cut = at + _PIECE
        while cut < len(text) and _RUN.match(text, cut):  # a run that goes on here stays whole
            cut = _RUN.match(text, cut).end()
        yield _RUN.findall(text, at, cut)
        at = cut
    yield _RUN.findall(text, at)


def _counted(batches):
    """(word, n) of documents (doc_id, text): some runs lose a character, chosen by a hash."""
    counts: Counter[str] = Counter()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                text = text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
                for runs in _runs(text):
                    for run, n in Counter(runs).items():
                        h = zlib.crc32(run.encode(), seed)
                        if h % 97 == 0:
                            cut = h % len(run)
                            run = run[:cut] + run[cut + 1 :]
                        if len(run) >= LEAST_CHARS:
                            counts[run] += n
            if len(counts) >= 2 * _ROWS:
                yield from _tables(counts.items())
                counts.clear()
    yield from _tables(counts.items())


def _tables(items):
    items = list(items)
    for at in range(0, len(items), _ROWS):
        words, numbers = zip(*items[at : at + _ROWS], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, word, n) of words with at least LEAST_CHARS code points and LEAST_TIMES occurrences; ids in code-point order."""
    counted = docs.select(doc_id, text).mapInArrow(_counted, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)
    words = stored(docs.sparkSession, words, "words")
    return stored(docs.sparkSession, words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def _sides(word: str) -> tuple[list[bytes], list[bytes]]:
    """Hashes of what stands in front of each place, and from each place on."""
    out = []
    for chars in (word, word[::-1]):
        state = blake2b(digest_size=16)
        own = [state.digest()]
        for c in chars:
            state.update(c.encode("utf-8", "surrogatepass").ljust(4, b"\xff"))
            own.append(state.copy().digest())
        out.append(own)
    return out[0], out[1][::-1]


def prefixes(word: str):
    """(prefix of a rotation, kind) for the rotations that lack one character and for the whole ones."""
    n = len(word)
    if n > LONG:
        front, back = _sides(word)
    for i in range(n):
        kind = _LATER if i and word[i] == word[i - 1] else _FIRST
        yield (f"{word[i + 1 :]}\0{word[:i]}".encode() if n - 1 <= LONG else back[i + 1] + front[i]), kind
    for i in range(n + 1):
        yield (f"{word[i:]}\0{word[:i]}".encode() if n <= LONG else back[i] + front[i]), _WHOLE


def _rotated(batches):
    """(prefix, id, n, kind) of words (id, word, n)."""
    names = ["prefix", "id", "n", "kind"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.int8()]
    rows: list[tuple] = []
    for batch in batches:
        for own, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for prefix, kind in prefixes(word):
                rows.append((prefix, own, n, kind))
                if len(rows) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of words (id, word, n) that have near ones; best is (-n, id) of the most frequent, then first."""
    rotated = words.select("id", "word", "n").mapInArrow(_rotated, "prefix binary, id long, n long, kind tinyint")
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    groups = rotated.groupBy("prefix").agg(F.sort_array(F.collect_list(member)).alias("members")).where(F.size("members") > 1)

    def near(x):
        def meets(y):
            replaced = (x["kind"] > _WHOLE) & (y["kind"] > _WHOLE) & (x["id"] != y["id"])
            edited = (x["kind"] + y["kind"] == _FIRST) & (x["kind"] != y["kind"])
            return replaced | edited

        own = F.filter("members", meets)
        return F.struct(x["id"].alias("id"), F.size(own).cast("long").alias("n_near"), F.get(own, F.lit(0)).alias("best"))

    found = groups.select(F.explode(F.transform("members", near)).alias("m")).select("m.id", "m.n_near", "m.best").where("n_near > 0")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("best.less", "best.id")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of links (id, form) without circles: the end of each chain, by doubling."""
    spark = forms.sparkSession
    hops = stored(spark, forms.select("id", F.col("form").alias("root")), "hops")
    while True:
        further = hops.select(F.col("id").alias("root"), F.col("root").alias("top"))
        hops = stored(spark, hops.select("id", "root").join(further, "root", "left").select("id", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "hops")
        if hops.where("moved").isEmpty():
            return hops.select("id", "root")
        hops = hops.select("id", "root")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of the documents."""
    spark = docs.sparkSession
    words = vocabulary(docs, doc_id, text)
    near = stored(spark, neighbours(words), "near")
    known = words.select("id", "n").join(near, "id")
    forms = stored(spark, known.where(-F.col("best.less") >= 2 * F.col("n")).select("id", F.col("best.id").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    named = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    ended = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    led = forms.join(_roots(forms), "id").join(named, "form").join(ended, "root").select("id", "form_word", "form_n", "root_word")
    done = words.join(near.select("id", "n_near"), "id", "left").join(led, "id", "left")
    return done.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )
