"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A text is
parsed, from left to right, into the longest phrases that occur in the sample; a letter that does
not occur is a phrase of its own. Phrases times the bits of a place in the sample, per character,
estimate the cross entropy of the text under the language, and the lowest estimate wins.

Only letters count: letters are lower-cased, each run of other characters is one blank. A text is
parsed in segments of SEGMENT characters, each of which starts a new phrase, so that thousands of
segments go through an automaton side by side. The whole text is parsed.

Defined cases: null text, and text without letters, is `und` with score 0; so is any text if
nothing could be learned. Equal estimates go to the smaller language name. Null or repeated ids
do no harm, as rows are independent of each other. Columns of the input are kept as they are; a
new column whose name is taken replaces that column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from bidmill.llm.common import hash_limit, unused

UNKNOWN = "und"
SEGMENT = 512
LANES = 8192
#: Bounds of the sample of each language: documents, and characters of each document, which are
#: taken in SAMPLE_PARTS parts at hashed places all over the text.
SAMPLE_DOCS = 96
SAMPLE_CHARS = 400
SAMPLE_PARTS = 4

_BLANK = 0
_STATE_BITS = 29


@dataclass
class LanguageModel:
    """Languages, the codes of their letters, and one transition table for each language."""

    languages: list[str]
    letters: dict[str, int]
    width: int  # codes; the last but one stands for unknown letters, the last for padding
    tables: list[np.ndarray]
    bits: list[float]


def held_out(doc_id: Column) -> Column:
    """True for the documents that are kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Learn from at most sample_docs different documents of each language, sample_chars of each.

    The documents with the smallest hashes of their text are taken. The hash is first cut off where
    about twice as many as needed remain, so that only these leave the executors. Texts of more than
    sample_chars characters give a part of each quarter, at a place that the hash picks: any character
    can be in the sample.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"), _sampled(F.col(text), sample_chars).alias("parts")
    )
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    if not counts:
        return LanguageModel([], {}, 3, [], [])
    limit = F.lit(None).cast("long")
    for name, n in counts.items():
        share = (2 * sample_docs + 8) / max(1, n)
        limit = F.when(F.col("lang") == name, F.lit(hash_limit(share))).otherwise(limit)
    rows = known.where(F.col("hash") <= limit).groupBy("lang", "hash").agg(F.min("parts").alias("parts")).collect()
    parts: dict[str, list[list[str]]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.hash)):
        if len(own := parts.setdefault(row.lang, [])) < sample_docs:
            own.append(row.parts)
    return build({name: [part for of_doc in own for part in of_doc] for name, own in parts.items()})


def _sampled(text: Column, chars: int) -> Column:
    """The whole text if it has at most the given characters, else an equal part of each of its stretches."""
    size, count = F.char_length(text), min(SAMPLE_PARTS, max(1, chars))
    parts = []
    for k in range(count):
        own = chars * (k + 1) // count - chars * k // count
        first, end = F.floor(size * k / count), F.floor(size * (k + 1) / count)
        places = F.greatest(end - first - own, F.lit(0)) + 1
        at = first + F.pmod(F.xxhash64(text, F.lit(k)), places)
        parts.append(F.substring(text, at.cast("int") + 1, F.lit(own)))
    return F.when(size <= chars, F.array(text)).otherwise(F.array(*parts))


def build(parts: dict[str, list[str]]) -> LanguageModel:
    """The model of given texts of each language."""
    languages = sorted(parts)
    seen = sorted({c for own in parts.values() for part in own for c in part.lower() if c.isalpha()})
    letters = {c: i + 1 for i, c in enumerate(seen)}
    model = LanguageModel(languages, letters, len(letters) + 3, [], [])
    for name in languages:
        coded = [_codes(p, model) for p in parts[name]]
        model.tables.append(_transitions(coded, model.width))
        model.bits.append(float(np.log2(max(2, sum(map(len, coded))))))
    return model


def _automaton(coded: list[np.ndarray]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of several texts; no phrase goes from one to the next."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def copy_of(state: int, parent: int, code: int) -> int:
        following.append(dict(following[state]))
        length.append(length[parent] + 1)
        link.append(link[state])
        new = len(following) - 1
        while parent >= 0 and following[parent].get(code) == state:
            following[parent][code] = new
            parent = link[parent]
        link[state] = new
        return new

    for text in coded:
        last = 0
        for code in text.tolist():
            if (known := following[last].get(code)) is not None:
                last = known if length[known] == length[last] + 1 else copy_of(known, last, code)
                continue
            following.append({})
            length.append(length[last] + 1)
            link.append(0)
            new, state = len(following) - 1, last
            while state >= 0 and code not in following[state]:
                following[state][code] = new
                state = link[state]
            if state >= 0:
                target = following[state][code]
                link[new] = target if length[target] == length[state] + 1 else copy_of(target, state, code)
            last = new
    return following


def _transitions(coded: list[np.ndarray], width: int) -> np.ndarray:
    """For each state and code: the next state times width, and above it the phrases that ended.

    Where the automaton has no transition the phrase ends and the code starts the next one; a code
    that is not in the sample is a phrase by itself. Padding leaves a state as it is.
    """
    following = _automaton(coded)
    if len(following) * width >= 1 << _STATE_BITS:
        raise ValueError("the sample is too large for its table; lower sample_docs or sample_chars")
    ended = 1 << _STATE_BITS
    first = np.full(width, ended, np.int64)  # from the start: unknown codes
    for code, state in following[0].items():
        first[code] = state * width
    table = np.empty((len(following), width), np.int64)
    table[0] = first
    table[1:] = first + ended
    for state, known in enumerate(following):
        for code, target in known.items():
            table[state, code] = target * width
    table[:, width - 1] = np.arange(len(following)) * width
    return table.astype(np.uint32).ravel()


@lru_cache(4)
def _code_table(letters: tuple[str, ...]) -> np.ndarray:
    known = {c: i + 1 for i, c in enumerate(letters)}
    table = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = known.get(c.lower()[0], len(letters) + 1)
    return table


def _codes(text: str, model: LanguageModel) -> np.ndarray:
    codes, lengths = _coded([text], model)
    return codes[: lengths[0]]


def _coded(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, one after the other, and how many each text has."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _code_table(tuple(model.letters))[points]
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], ends[:-1]])
    keep = codes != _BLANK
    keep[1:] |= codes[:-1] != _BLANK  # the first blank of a run
    keep[starts[starts < len(codes)]] = codes[starts[starts < len(codes)]] != _BLANK
    upto = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], upto[ends] - upto[starts]


def estimates(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Bits per character of each text under each language, and the characters that count."""
    codes, lengths = _coded(texts, model)
    pieces = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = (np.cumsum(lengths) - lengths)[owner] + number * SEGMENT
    size = np.minimum(lengths[owner] - number * SEGMENT, SEGMENT)
    order = np.argsort(-size, kind="stable")
    phrases = np.zeros((len(model.languages), len(texts)))
    padded = np.concatenate([codes, np.full(SEGMENT, model.width - 1, codes.dtype)])
    for at in range(0, len(order), LANES):
        lanes = order[at : at + LANES]
        steps = np.arange(size[lanes[0]])[:, None]
        block = padded[start[lanes] + steps]
        block[steps >= size[lanes]] = model.width - 1
        for k, table in enumerate(model.tables):
            phrases[k] += np.bincount(owner[lanes], _parsed(block.astype(np.uint32), table), len(texts))
    with np.errstate(divide="ignore", invalid="ignore"):
        return phrases * np.array(model.bits)[:, None] / lengths, lengths


def _parsed(block: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Phrases of each column of the block."""
    state = np.zeros(block.shape[1], np.uint32)
    count = np.zeros(block.shape[1], np.uint32)
    low, shift = np.uint32((1 << _STATE_BITS) - 1), np.uint32(_STATE_BITS)
    value = np.empty_like(state)
    for codes in block:
        np.add(state, codes, out=state)
        np.take(table, state, out=value, mode="clip")
        np.bitwise_and(value, low, out=state)
        np.right_shift(value, shift, out=value)
        np.add(count, value, out=count)
    return count + (state != 0)


NEW_COLUMNS = ("lang_pred", "score", "bits")


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", new: tuple[str, str, str] = NEW_COLUMNS) -> DataFrame:
    """The rows with lang_pred, score (0 to 1) and bits (per character, null for `und`).

    The score is the share of the second language in the sum of the two lowest estimates: 0.5 where
    both fit alike, 1 where there is only one language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]
    schema = StructType([*kept, StructField(new[0], StringType()), StructField(new[1], DoubleType()), StructField(new[2], DoubleType())])
    names = [f.name for f in kept]

    def run(batches):
        model = shared.value
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            labels, scores, bits = [], [], []
            for at in range(0, batch.num_rows, 512):
                for row in _judged([t or "" for t in column.slice(at, 512).to_pylist()], model):
                    labels.append(row[0])
                    scores.append(row[1])
                    bits.append(row[2])
            columns = [batch.column(batch.schema.names.index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())],
                [*names, *new],
            )

    return docs.mapInArrow(run, schema)


def _judged(texts: list[str], model: LanguageModel) -> list[tuple[str, float, float | None]]:
    if not model.languages or not any(texts):
        return [(UNKNOWN, 0.0, None)] * len(texts)
    bits, lengths = estimates(texts, model)
    best = np.argmin(bits, axis=0)
    ranked = np.sort(bits, axis=0)
    out = []
    for i, n in enumerate(lengths):
        if not n:
            out.append((UNKNOWN, 0.0, None))
            continue
        low = float(ranked[0, i])
        score = float(ranked[1, i]) / (low + float(ranked[1, i])) if len(ranked) > 1 else 1.0
        out.append((model.languages[best[i]], score, low))
    return out


def identify(docs: DataFrame, new: tuple[str, str, str] = NEW_COLUMNS) -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all documents."""
    return predict(docs, learn(docs.where(~held_out(F.col("doc_id")))), new=new)


def in_a_language(docs: DataFrame, most_bits: float = 4.2, least_chars: int = 64) -> DataFrame:
    """Drop texts without a language: `und`, and longer ones that fit no language that was learned.

    Random letters need about log2(27) = 4.75 bits each, text of a known language half of that.
    Texts of fewer than least_chars characters are too short for this measure and stay.
    """
    lang, score, bits = (unused(docs, n) for n in NEW_COLUMNS)
    fits = (F.col(bits) <= most_bits) | (F.length("text") < least_chars)
    return identify(docs, (lang, score, bits)).where((F.col(lang) != UNKNOWN) & fits).select(docs.columns)
