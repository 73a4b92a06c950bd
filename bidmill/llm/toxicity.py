"""Severity of toxic text by cumulative-link ordinal regression.

A document has a set of sparse features: its lower-cased words, and marks of its form (much in
capitals, many symbols, many repeated words), each as a 32-bit hash. One weight for each feature gives a single value; ordered thresholds cut that value into
grades: P(grade > k) = logistic(value - threshold k). All thresholds share the weights. The weights
carry an L1 penalty, so that words without a part in the grades count nothing.

Grades of a labelled document: 2 if toxic, else 1 if of low quality, else 0.

Defined cases: null text has no features and so the severity of text without any known feature, as
has empty text. Labels with null parts, of unknown documents or with null ids are left out. If
fewer than two grades are labelled, all documents get the single grade, or 0 without any. Rows
are independent of each other; repeated ids do no harm. A new column whose name is taken replaces
that column.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from bidmill.llm.common import hash_limit

#: Bound of the labelled sample, and the documents of it that a feature must be in.
SAMPLE_ROWS = 10_000
LEAST_DOCS = 3
TOXIC = 2
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_SYMBOLS = b"!#$%&*+<=>?@^_|~"


@dataclass
class OrdinalModel:
    weights: dict[int, float]
    thresholds: np.ndarray  # ascending; grades are 0 to len(thresholds)
    lowest: int = 0  # the only grade, if there are no thresholds


def features(text: str | None) -> set[int]:
    """Hashes of the words and marks of a text."""
    if not text:
        return set()
    data = text.encode("utf-8", "surrogatepass")
    words = data.translate(_CLEAN).split()
    found = set(words)
    if 2 * len(found) < len(words):
        found.add(b" repeats")
    letters = len(data) - len(data.translate(None, _LETTERS))
    if letters and 2 * (len(data) - len(data.translate(None, _CAPITALS))) > letters:
        found.add(b" capitals")  # no word has a blank
    if 20 * (len(data) - len(data.translate(None, _SYMBOLS))) > len(data):
        found.add(b" symbols")
    return set(map(crc32, found))


def fit(docs: list[list[int]], grades: list[int], penalty: float = 2e-4, rounds: int = 300) -> OrdinalModel:
    """Weights and thresholds by accelerated proximal gradient steps on the mean negative log-likelihood."""
    top = max(grades, default=0)
    if len(set(grades)) < 2:
        return OrdinalModel({}, np.zeros(0), top)
    counts: dict[int, int] = {}
    for own in docs:
        for word in own:
            counts[word] = counts.get(word, 0) + 1
    names = sorted(w for w, n in counts.items() if LEAST_DOCS <= n)
    number = {w: i for i, w in enumerate(names)}
    rows = [np.array(sorted(number[w] for w in own if w in number), np.int64) for own in docs]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([np.zeros(0, np.int64), *rows])
    y = np.array(grades)
    share = np.array([(y > k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    cuts = -np.log(share / (1 - share))
    w = np.zeros(len(names))
    ahead_w, ahead_cuts, momentum, step = w, cuts, 1.0, 0.5

    def loss(w, cuts):
        value = np.bincount(owner, w[column], len(rows))
        at_least = _logistic(value[:, None] - cuts)
        upper = np.where(y > 0, at_least[np.arange(len(y)), np.maximum(y - 1, 0)], 1.0)
        lower = np.where(y < top, at_least[np.arange(len(y)), np.minimum(y, top - 1)], 0.0)
        p = np.maximum(upper - lower, 1e-12)
        # dP/dvalue of each side; thresholds have the opposite sign.
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        slope = -(up - low) / len(y)
        g_cuts = np.zeros(top)
        np.add.at(g_cuts, np.maximum(y - 1, 0), np.where(y > 0, up, 0.0) / len(y))
        np.add.at(g_cuts, np.minimum(y, top - 1), -np.where(y < top, low, 0.0) / len(y))
        return -np.log(p).mean(), np.bincount(column, slope[owner], len(names)), g_cuts

    for _ in range(rounds):
        now, g_w, g_cuts = loss(ahead_w, ahead_cuts)
        while True:
            new_w = ahead_w - step * g_w
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
            new_cuts = np.maximum.accumulate(ahead_cuts - step * g_cuts)
            d_w, d_cuts = new_w - ahead_w, new_cuts - ahead_cuts
            bound = now + g_w @ d_w + g_cuts @ d_cuts + (d_w @ d_w + d_cuts @ d_cuts) / (2 * step)
            if loss(new_w, new_cuts)[0] <= bound + 1e-12 or step < 1e-6:
                break
            step /= 2
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead_w = new_w + (momentum - 1) / following * (new_w - w)
        ahead_cuts = np.maximum.accumulate(new_cuts + (momentum - 1) / following * (new_cuts - cuts))
        w, cuts, momentum, step = new_w, new_cuts, following, step * 1.2
    return OrdinalModel({names[i]: float(w[i]) for i in np.flatnonzero(w)}, cuts)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit to at most about sample_rows labelled documents, taken by a hash of their id.

    Of several labels of a document the gravest grade counts.
    """
    grade = F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 0, 1).otherwise(0)
    graded = labels.where("doc_id is not null and toxic is not null and quality is not null").select("doc_id", grade.alias("grade"))
    n = graded.count()
    share = sample_rows / max(1, n)
    chosen = F.xxhash64(F.col("doc_id").cast("long"), F.lit(7)) <= F.lit(hash_limit(share))
    picked = graded.where(chosen).groupBy("doc_id").agg(F.max("grade").alias("grade"))
    rows = docs.select("doc_id", "text").where(chosen).join(picked, "doc_id").select("text", "grade")
    found = _featured(rows).collect()
    return fit([r.words for r in found], [r.grade for r in found])


def _featured(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            words = [sorted(features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.int64())), batch.column(1)], ["words", "grade"])

    return rows.mapInArrow(run, "words array<long>, grade int")


NEW_COLUMNS = ("severity", "p_toxic", "toxic")


def predict(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The rows with the expected severity, the chance of the toxic grade, and whether it is over a half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name.lower() not in NEW_COLUMNS]
    names = [f.name for f in kept]
    schema = StructType(kept)
    for name, kind in zip(NEW_COLUMNS, (DoubleType(), DoubleType(), BooleanType()), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        model = shared.value
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            value = np.array([_value(t.as_py(), model) for t in column[text]])
            if len(model.thresholds):
                over = _logistic(value[:, None] - model.thresholds)
                severity = over.sum(axis=1)
                toxic = over[:, TOXIC - 1] if over.shape[1] >= TOXIC else np.zeros(len(value))
            else:
                severity = np.full(len(value), float(model.lowest))
                toxic = (severity >= TOXIC).astype(float)
            arrays = [pa.array(severity), pa.array(toxic), pa.array(toxic > 0.5)]
            yield pa.RecordBatch.from_arrays([*(column[n] for n in names), *arrays], [*names, *NEW_COLUMNS])

    return docs.mapInArrow(run, schema)


def _value(text: str | None, model: OrdinalModel) -> float:
    get = model.weights.get
    return sum(get(w, 0.0) for w in sorted(features(text) & model.weights.keys()))
