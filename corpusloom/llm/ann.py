"""Nearest neighbours by collision counting (operator 9).

Vectors are dealt out into blocks.  A block projects its vectors on random lines
and sorts each projection.  A query opens a window around its own projection on
every line and widens all of them together, radius by radius (virtual
rehashing: no buckets are fixed beforehand).  A vector that lies in the windows
of enough lines is verified: its distance is computed in double precision.  The
search of a block ends when k verified vectors lie within the radius, or all
have been verified; the best of all blocks are the result.

The threshold follows from the bounds of errors.  The lines come as orthogonal
bases, each stretched so that a distance s appears on a line as about a normal
number of spread s.  With windows of one radius to either side, a vector at the
radius lies in each with the probability p = 0.68, and in fewer of all lines than the
threshold with the probability MISS; the squares of a basis's projections add up
to the squared distance, which makes the count more certain than with independent lines.
The farther a vector, the less often it reaches the threshold; its share of
all is what decides about the work.  The query set is stated beforehand, and each
query is sent to every block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.operators.order import cut_lineage


#: Lines, and the probability that a vector at the radius of the search is not verified.
LINES, MISS = 128, 0.1


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def threshold(lines: int, dim: int, miss: float = MISS) -> int:
    """Windows in which a vector at the radius lies but for a probability of ``miss``."""
    normal = NormalDist()
    p = 2 * normal.cdf(1.0) - 1
    # The correlation, squared, of lying in a window with the square of the projection, whose sum over a basis is known.
    known = (2 * normal.pdf(1.0)) ** 2 / (2 * p * (1 - p)) * min(1.0, lines / dim)
    return max(1, math.floor(lines * p - normal.inv_cdf(1 - miss) * math.sqrt(lines * p * (1 - p) * (1 - known))))


class Block:
    """The sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: int = LINES, growth: float = 1.1, seed: int = 7):
        self.ids, self.vectors, self.growth = ids, vectors, growth
        dim = vectors.shape[1]
        rng = np.random.default_rng(seed)
        bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] * math.sqrt(dim) for _ in range(-(-lines // dim))]
        self.lines = np.concatenate(bases, 1)[:, :lines]
        projected = vectors @ self.lines
        self.order = np.argsort(projected, 0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.take_along_axis(projected.T, self.order.astype(np.int64), 1)
        self.threshold = threshold(lines, dim)
        spread = float(np.linalg.norm(vectors.std(0)))
        self.first = spread / 2 if spread > 0 else 1.0

    def nearest(self, query: np.ndarray, k: int, own: int | None) -> tuple[list[tuple[float, int]], int]:
        """(distance, id) of the k nearest found, ties to the smaller id, without the query's own row (id ``own``); and how many were verified."""
        at = query @ self.lines
        n, lines = len(self.ids), len(self.sorted)
        low = np.array([np.searchsorted(self.sorted[i], at[i]) for i in range(lines)])
        high = low.copy()
        count = np.zeros(n, np.int32)
        seen = np.zeros(n, bool)
        best: list[tuple[float, int]] = []
        radius = self.first
        while True:
            touched = []
            for i in range(lines):
                row = self.sorted[i]
                a = int(row[: low[i]].searchsorted(at[i] - radius))
                b = int(high[i] + row[high[i] :].searchsorted(at[i] + radius, "right"))
                touched += [self.order[i, a : low[i]], self.order[i, high[i] : b]]
                low[i], high[i] = a, b
            count += np.bincount(np.concatenate(touched), minlength=n).astype(np.int32)
            new = np.flatnonzero((count >= self.threshold) & ~seen)
            if len(new):
                seen[new] = True
                far = np.sqrt(((self.vectors[new] - query) ** 2).sum(1))
                ids = self.ids[new]
                if own is not None:
                    far, ids = far[ids != own], ids[ids != own]
                if len(far) > k:
                    edge = np.partition(far, k - 1)[k - 1]
                    far, ids = far[far <= edge], ids[far <= edge]
                top = np.lexsort((ids, far))[:k]
                best = sorted([*best, *zip(far[top].tolist(), ids[top].tolist(), strict=True)])[:k]
            if seen.all() or len(best) == k and best[-1][0] <= radius:
                return best, int(seen.sum())
            # Never farther than to the k-th found; rounding must not stop the growth.
            radius = min(radius * self.growth, max(best[-1][0], radius * 1.0001)) if len(best) == k else radius * self.growth


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, block_rows: int = 16_384) -> DataFrame:
    """For each row of ``vectors(vec_id, embedding)`` whose id is divisible by ``every``: query_id, rank, vec_id, score.

    ``score`` is the Euclidean distance in double precision; ties go to the
    smaller vec_id.  Null ids, and vectors that are null, empty, zero or hold
    null or non-finite components, take no part; all vectors must have one
    length, or a ValueError is raised.  Repeated rows of an id are each a
    candidate for other queries, and the id is one query by its first vector in
    order of components.  Other columns are ignored.
    """
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    stats = rows.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if stats.n and stats.low != stats.high:
        raise ValueError("vectors of different lengths")
    blocks = max(1, -(-stats.n // block_rows))
    own = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    data = rows.select(own.alias("block"), F.lit(0).alias("kind"), "vec_id", "v")
    # The stated queries meet all rows, block by block: they are copied once for every block of vectors.
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v")
    dealt = data.unionAll(copies).repartitionByRange(max(1, blocks), "block").sortWithinPartitions("block", "kind", "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        index, at = None, None
        for batch in batches:
            block, kind, ids = (batch.column(i).to_numpy() for i in range(3))
            if not len(ids):
                continue
            matrix = batch.column(3).flatten().to_numpy().reshape(len(ids), -1)
            out: list[tuple[int, int, float]] = []
            borders = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]))
            for start, stop in zip(borders, [*borders[1:], len(ids)], strict=True):
                if block[start] != at:
                    held, index, at = [], None, block[start]
                if kind[start] == 0:
                    held.append((ids[start:stop], matrix[start:stop]))
                    continue
                if index is None and held:
                    index = Block(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                    held = []
                for r in range(start, stop) if index is not None else ():
                    out += [(int(ids[r]), i, d) for d, i in index.nearest(matrix[r], k, int(ids[r]))[0]]
            q, v, d = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return cut_lineage(found).select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
