"""A quality classifier: gradient-boosted trees over document statistics (operator 2).

Statistics of whole texts are put into at most 64 bins; trees are grown level
by level from histograms of gradients, as in LightGBM, on a bounded sample of
labelled rows, and flattened into arrays, which numpy walks for a batch of
documents at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from corpusloom.llm.shared import sliced, unused

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_SENTENCE = b".,;:?'\"-"
_MARKS = b"#$%&*+/<=>@[\\]^_`{|}~"
_BEYOND = bytes(range(128, 256))
FEATURES = (
    "log_bytes", "log_words", "upper", "lower", "digit", "space", "sentence_marks", "other_marks", "exclamations", "pipes", "beyond_ascii",
    "word_length", "word_length_spread", "distinct_words", "top_word", "distinct_pairs", "lines", "line_length", "distinct_lines", "marked_words",
    "capital_words", "one_letter_words", "stops_per_word", "runs", "digit_words",
)


def statistics(text: str | None) -> list[float]:
    """FEATURES of a whole text; of null as of an empty one."""
    data = (text or "").encode()
    n = max(1, len(data))
    part = lambda chars: (len(data) - len(data.translate(None, chars))) / n
    words = data.split()
    k = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    marked = len({w for w in counts if w.translate(None, _UPPER + _LOWER + _BEYOND + _SENTENCE)}) / max(1, len(counts))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    return [
        float(np.log1p(len(data))), float(np.log1p(len(words))), part(_UPPER), part(_LOWER), part(_DIGIT), part(_SPACE), part(_SENTENCE), part(_MARKS), part(b"!"), part(b"|"), part(_BEYOND),
        float(lengths.mean()), float(lengths.std()), len(counts) / k, counts.most_common(1)[0][1] / k if counts else 0.0, pairs, float(np.log1p(len(lines))), float(np.log1p(len(data) / m)), len(set(lines)) / m, marked,
        sum(w[:1].isupper() for w in counts) / max(1, len(counts)), sum(c for w, c in counts.items() if len(w) == 1) / k, data.count(b".") / k, sum(data.count(x) for x in (b"!!", b"..", b"--", b"##", b"**", b"$$", b"%%", b"&&")) / k, sum(w.isdigit() for w in counts) / max(1, len(counts)),
    ]


@dataclass
class Trees:
    """All trees in flat arrays: a node's feature (-1: leaf), its bound, its left child (the right one follows), its value."""

    roots: np.ndarray
    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                go = x[rows, np.maximum(self.feature[at], 0)] > self.bound[at]
                at = np.where(inner, self.left[at] + go, at)
            total += self.value[at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 64, least: int = 10, ridge: float = 1.0) -> Trees:
    """Fits log-loss.  With one class or no rows there is no tree and the score is that class's share, smoothed (no rows: 0.5)."""
    share = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    roots, feature, bound, left, value = [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            roots.append(len(feature))
            feature.append(-1), bound.append(0.0), left.append(0), value.append(0.0)
            level, at = [roots[-1]], np.full(len(y), roots[-1])
            for d in range(depth + 1):
                slot = np.full(len(feature), -1)
                slot[level] = np.arange(len(level))
                mine = slot[at]
                live = mine >= 0
                k = len(level)
                gs, hs = np.bincount(mine[live], g[live], k), np.bincount(mine[live], h[live], k)
                for i, node in enumerate(level):
                    value[node] = float(-rate * gs[i] / (hs[i] + ridge))
                if d == depth:
                    break
                best = [(1e-6, -1, 0)] * k
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    w = len(e) + 1
                    cell = mine[live] * w + binned[live, j]
                    gg, hh, nn = (np.bincount(cell, v, k * w).reshape(k, w).cumsum(1) for v in (g[live], h[live], np.ones(live.sum())))
                    gl, hl, nl = gg[:, :-1], hh[:, :-1], nn[:, :-1]
                    gr, hr, nr = gg[:, -1:] - gl, hh[:, -1:] - hl, nn[:, -1:] - nl
                    gain = np.where((nl >= least) & (nr >= least), gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (gg[:, -1:] ** 2) / (hh[:, -1:] + ridge), -1.0)
                    top = gain.argmax(1)
                    for i in range(k):
                        if gain[i, top[i]] > best[i][0]:
                            best[i] = (gain[i, top[i]], j, int(top[i]))
                following = []
                for i, node in enumerate(level):
                    _, j, cut = best[i]
                    if j < 0:
                        continue
                    feature[node], bound[node], left[node] = j, float(edges[j][cut]), len(feature)
                    for _ in range(2):
                        following.append(len(feature))
                        feature.append(-1), bound.append(0.0), left.append(0), value.append(0.0)
                    here = at == node
                    at[here] = left[node] + (binned[here, j] > cut)
                if not following:
                    break
                level = following
            raw += np.array(value)[at]
    return Trees(np.array(roots, np.int64), np.array(feature, np.int64), np.array(bound), np.array(left, np.int64), np.array(value), base)


def remainder(doc_id: str = "doc_id", of: int = 4):
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % of


def _features(docs: DataFrame, more: list[str]) -> DataFrame:
    names = [*more, "features"]
    kinds = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [statistics(x.as_py()) for x in batch.column(len(more))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(more)], pa.array(rows, pa.list_(pa.float64()))], names=names)

    return docs.select(*more, "text").mapInArrow(run, f"{kinds}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Trees:
    """Trees from at most ``sample`` labelled rows outside the held-out quarter, those of the smallest hashes.

    Repeated labels of a document count as one (1 if any is 1), and so do texts
    under one id (the one of the least statistics); null labels, unlabelled
    documents and labels without a document are not used.
    """
    usable = labels.filter((remainder() != 2) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = _features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "quality"])  # at most `sample` rows
    data = rows.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("features").alias("features")).orderBy("doc_id").collect()
    x = np.array([r.features for r in data]).reshape(-1, len(FEATURES))
    return grow(x, np.array([r.quality > 0 for r in data], float))


def score(docs: DataFrame, trees: Trees, least: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` and ``predicted`` to ``docs`` (columns ``keep``, by default doc_id), for every row, from its whole text.

    A null text is scored as an empty one.  If ``keep`` has columns of these
    names, the added ones end in an underscore.
    """
    names = keep or ["doc_id"]
    added = unused(["score", "predicted"], names)
    place = names.index("text") if "text" in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = np.array([statistics(t.as_py()) for t in batch.column(place)]).reshape(-1, len(FEATURES))
            s = trees.score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(s), pa.array((s >= least).astype(np.int32))], names=[*names, *added])

    kinds = StructType([*(docs.schema[n] for n in names), StructField(added[0], DoubleType()), StructField(added[1], IntegerType())])
    return docs.select(*(F.col(f"`{n}`") for n in names), *([] if "text" in names else ["text"])).mapInArrow(run, kinds)
