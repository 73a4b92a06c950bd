"""Exact top-k search by inner product, with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... equal segments. The means and deviations (the length of what
is left without the mean) of two segments bound their distance from below: n * (difference of means)**2 plus
(difference of deviations)**2. As the lengths of both vectors are known, a lower bound on the
distance is an upper bound on the inner product. Per query, a first few exact scores give a
threshold; candidates are then dropped from coarse to fine, and the survivors get exact scores in
whole numbers. The best of each slot of candidates are ranked once more over all slots.

Queries and candidates meet in cells (slot of candidates, block of queries), each of bounded size:
the stated query set goes against all rows in blocks. No cell needs more than its own rows.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do
rows without an id. Only vectors of equal length are compared. A query's own row is the row with
its id; rows that repeat the id are left out for it as well, and repeated query ids are searched once, with the
smallest vector. Equal scores go to the smaller id. With no other rows there are no results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_ROWS = 4096
LEAST_SLOTS = 64
BLOCK_QUERIES = 1024
_SEEDS = 4  # exact scores for the first threshold, as a multiple of k


def whole_numbers(embedding: Column) -> Column:
    """floor(1024 * x) of each component; null for vectors that take no part."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024).cast("long")))


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries among vectors (vec_id, v: array<long>)."""
    usable = vectors.where("vec_id is not null and v is not null").select("vec_id", "v", F.size("v").alias("d"))
    queries = usable.where(is_query).groupBy("vec_id", "d").agg(F.min("v").alias("v"))
    n, n_queries = usable.count(), queries.count()
    slots, blocks = max(LEAST_SLOTS, -(-n // SLOT_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(slots)).cast("int")
    candidates = usable.withColumn("slot", slot).withColumn("block", every)
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    keys = ("slot", "block", "d")

    def cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:  # a cell without one side
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        found = best(*_columns(queries), *_columns(candidates), k)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), found, strict=True)})

    met = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = met.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1)


def _statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means, scaled by the root of the segment's length, and deviations of each segment."""
    cuts = np.linspace(0, vectors.shape[1], segments + 1).astype(int)[:-1]
    sizes = np.diff(np.append(cuts, vectors.shape[1]))
    sums = np.add.reduceat(vectors, cuts, axis=1)
    squares = np.add.reduceat(vectors * vectors, cuts, axis=1)
    means = sums / np.sqrt(sizes)
    return means, np.sqrt(np.maximum(squares - means * means, 0))


def best(q_ids, queries, c_ids, candidates, k: int) -> tuple[list[int], list[int], list[int]]:
    """For each query its k highest scores among the candidates with other ids."""
    if not len(q_ids) or not len(c_ids) or not queries.shape[1]:
        return _scored(q_ids, queries, c_ids, candidates, *np.nonzero(q_ids[:, None] != c_ids), k)
    q, c = queries.astype(float), candidates.astype(float)
    q_size, c_size = (q * q).sum(1), (c * c).sum(1)
    slack = 1.0 + 1e-9 * (np.sqrt(q_size.max()) * np.sqrt(c_size.max()) + q_size.max() + c_size.max())
    levels = [s for s in (1, 2, 4, 8, 16, 32) if s <= q.shape[1]]
    stats = [(_statistics(q, s), _statistics(c, s)) for s in levels]

    def highest(level, rows, cols):
        """Upper bounds on scores: half of both sizes less the lower bound on the distance."""
        (q_mean, q_dev), (c_mean, c_dev) = stats[level]
        nearest = ((q_mean[rows] - c_mean[cols]) ** 2 + (q_dev[rows] - c_dev[cols]) ** 2).sum(-1)
        return (q_size[rows] + c_size[cols] - nearest) / 2

    other = q_ids[:, None] != c_ids
    middle = min(2, len(levels) - 1)
    bound = np.where(other, np.stack([highest(middle, i, slice(None)) for i in range(len(q))]), -np.inf)
    seeds = min(_SEEDS * k, len(c))
    first = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
    seeded = np.where(np.take_along_axis(other, first, 1), np.einsum("qd,qsd->qs", q, c[first]), -np.inf)
    least = np.sort(seeded, axis=1)[:, -k] if seeds >= k else np.full(len(q), -np.inf)
    # Coarse to fine: at each level only what the last one has left.
    coarse = np.stack([highest(0, i, slice(None)) for i in range(len(q))])
    rows, cols = np.nonzero(other & (coarse >= least[:, None] - slack))
    for level in range(1, len(levels)):
        keep = np.zeros(len(rows), bool)
        for at in range(0, len(rows), 100_000):
            part = slice(at, at + 100_000)
            keep[part] = highest(level, rows[part], cols[part]) >= least[rows[part]] - slack
        rows, cols = rows[keep], cols[keep]
    return _scored(q_ids, queries, c_ids, candidates, rows, cols, k)


def _scored(q_ids, queries, c_ids, candidates, rows, cols, k) -> tuple[list[int], list[int], list[int]]:
    most = [int(np.abs(v).max(initial=0)) for v in (queries, candidates)]
    if max(most) >= 1 << 62 or most[0] * most[1] * max(1, queries.shape[1]) >= 1 << 62:  # beyond 64 bits: saturated
        queries, candidates = queries.astype(object), candidates.astype(object)
        scores = np.array([max(-(1 << 63), min((1 << 63) - 1, sum(queries[i] * candidates[j]))) for i, j in zip(rows, cols, strict=True)], np.int64)
    else:
        parts = [np.einsum("nd,nd->n", queries[rows[at : at + 50_000]], candidates[cols[at : at + 50_000]]) for at in range(0, len(rows), 50_000)]
        scores = np.concatenate([np.zeros(0, np.int64), *parts])
    order = np.lexsort((c_ids[cols], ~scores, rows))  # ~x is -x - 1, without overflow
    rows, cols, scores = rows[order], cols[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    keep = place < k
    return q_ids[rows[keep]].tolist(), c_ids[cols[keep]].tolist(), scores[keep].tolist()
