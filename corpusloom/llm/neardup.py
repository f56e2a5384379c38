"""Near-duplicates by bottom-k sketches (operator 4).

One hash function orders all shingles.  A document's sketch is its lowest
hashes; documents with the same set count once.  Inverted lists of retained
values propose partners: of two sketches that overlap enough, the rarest values
must have one in common, so only each document's rarest retained values are
listed, which leaves out passages that many documents share.  Of the documents
with a list in common the full sets are made once.  Who has too many values that
no other of them has can have no partner and goes (exactly, by the full sets).

Near copies of one text would fill lists with pairs that are not quite similar
enough.  So every document joins the group of a leader, the one of its lists
with the fewest values of its own, and a group is solved around its core (the
values that most members have).  The distance of two sets is that of their
differences from the core; a bound from the sizes of these and from the values
that nobody else has refutes nearly all pairs without looking at them, and the
others are compared exactly.  A group costs about a comparison a member.  Only
pairs of one list across groups and components are left; the sketch of their
union estimates the similarity, and the full sets decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.pieces import Memo
from corpusloom.llm.shared import components, sliced, sole
from corpusloom.operators.order import cut_lineage

#: Values listed, and values kept for the estimate.
LISTED, KEPT = 32, 128
#: Probability of missing a pair of exactly the least similarity, at most, in either step.
MISS = 1e-9
#: Rows of a block of a long list, and values of a block of a large group.
BLOCK, GROUP_VALUES = 1024, 500_000
#: Ids up to which the verification broadcasts them (8 bytes each) to choose its texts.
BROADCAST_IDS = 200_000


def _word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


@sole
def _word_hashes() -> Memo:
    return Memo(_word_hash, max_chars=20_000_000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles: runs of ``words`` words, or all words if there are fewer; none without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hashes().__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
    return np.unique(total)


def least_overlap(k: int, percent: int, miss: float = MISS) -> int:
    """How many of the k lowest values of a union both sets have at least, but for a probability of ``miss``."""
    p, below, m = percent / 100, 0.0, 0
    while m <= k:
        below += comb(k, m) * p**m * (1 - p) ** (k - m)
        if below > miss:
            break
        m += 1
    return max(1, m)


def _arrays(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, rows)], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *(x.view(np.int64) for x in rows)])))


def _digest(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes())


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, n, key, sketch) of every row: size and digest of its set, and the lowest LISTED hashes, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [shingles(text.as_py(), words) for text in batch.column(2)]
            n = pa.array([len(x) for x in found], pa.int64())
            keys = pa.array([_digest(x) if len(x) else None for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n, keys, _arrays([x[:LISTED] for x in found])], names=["doc_id", "text_hash", "n", "key", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, n long, key binary, sketch array<long>")


def _padded(column: pa.ListArray) -> np.ndarray:
    """Sketches as rows of unsigned values, filled up with the highest value."""
    out = np.full((len(column), KEPT), np.iinfo(np.uint64).max, np.uint64)
    for i, values in enumerate(column):
        v = values.values.to_numpy(zero_copy_only=False).view(np.uint64)
        out[i, : len(v)] = v
    return out


def promising(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may reach the similarity: by their sizes, and by how many of the union's lowest values both have."""
    both = np.sort(np.concatenate([a, b], 1), 1)
    twice = both[:, 1:] == both[:, :-1]
    real = both[:, :-1] != np.iinfo(np.uint64).max
    distinct = np.cumsum(np.concatenate([np.ones((len(both), 1), bool), ~twice], 1), 1)[:, :-1]
    twice &= real
    common = (twice & (distinct <= KEPT)).sum(1)
    whole = (na <= KEPT) & (nb <= KEPT)
    low, high = np.minimum(na, nb), np.maximum(na, nb)
    # Sets held whole are compared whole, also where their union has more values than a sketch.
    shared = twice.sum(1)
    exact = 100 * shared >= percent * (na + nb - shared)
    return (100 * low >= percent * high) & np.where(whole, exact, common >= np.minimum(least_overlap(KEPT, percent), 0.8 * low))


def _keys(reps: DataFrame, percent: int) -> DataFrame:
    """(value, node): each node's rarest listed values, as many as a partner must share one of."""
    size = F.least(F.col("n"), F.lit(LISTED))
    sure = F.ceil(F.col("n") * percent / 100) - F.greatest(F.floor(F.col("n") * 100 / percent) - LISTED, F.lit(0))
    needed = size - F.when(F.col("n") < LISTED, sure).otherwise(least_overlap(LISTED, percent)) + 1
    every = reps.select("node", needed.alias("needed"), size.alias("size"), F.explode("sketch").alias("value"))
    # A value that one document has is rarer than all others and has no partner: it only uses up a place.
    shared = every.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    found = every.join(shared, "value").groupBy("node").agg(F.first("needed").alias("needed"), F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))
    places = F.col("needed") - (F.col("size") - F.size("values"))
    return found.filter(places > 0).select("node", F.explode(F.slice("values", 1, places.cast("int"))).alias("v")).select(F.col("v.value").alias("value"), "node")


def _sets(docs: DataFrame, alive: DataFrame, words: int) -> DataFrame:
    """(node, n, values) of the nodes ``alive(node, rep, rep_hash, key)``, each from one of its texts."""
    few = alive.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # a checked size
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    wanted = F.broadcast(alive) if few else alive
    rows = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("text_hash") == F.col("rep_hash"))).select("node", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            nodes, sets = [], []
            for node, key, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                found = shingles(text.as_py(), words)
                if _digest(found) == key.as_py():  # else another text of the same hash
                    nodes.append(node.as_py())
                    sets.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), _arrays(sets)], names=["node", "n", "values"])

    # Repeated rows give a set several times.
    return rows.mapInArrow(run, "node long, n long, values array<long>").groupBy("node").agg(F.first("n").alias("n"), F.first("values").alias("values"))


def _with_own(sets: DataFrame, percent: int) -> DataFrame:
    """Adds ``own``, how many values no other set has; sets with too many of them for any partner go."""
    every = sets.select("node", F.explode("values").alias("value"))
    own = every.groupBy("value").agg(F.count("*").alias("df"), F.min("node").alias("node")).filter("df = 1").groupBy("node").agg(F.count("*").alias("own"))
    return sets.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0))).filter(F.col("own") * 100 <= F.col("n") * (100 - percent))


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches don't rule out."""
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_s"))
    fit = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    rows = pairs.join(side("a"), "a").join(side("b"), "b").filter(fit).select("a", "b", "a_n", "b_n", "a_s", "b_s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
            keep = promising(_padded(batch.column(4)), _padded(batch.column(5)), *n, percent) if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in range(2)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _centred(lists: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(node, center): of the leaders of a node's lists that it may be similar to the best one, or else the node.

    The best leader has the least share of values of its own: it is near the
    text that all are copies of.  A leader with a better leader passes its
    nodes on to that.
    """
    rated = sketches.select("node", F.struct((F.col("own") / F.col("n")).alias("share"), F.xxhash64("node").alias("h"), "node").alias("rank"))
    ranked = lists.join(rated, "node")
    leaders = ranked.groupBy("value").agg(F.min("rank").alias("leader"))
    pairs = ranked.join(leaders, "value").filter("rank != leader").select(F.col("node").alias("a"), F.col("leader.node").alias("b")).distinct()
    near = _estimated(pairs, sketches, percent).join(rated.select(F.col("node").alias("b"), "rank"), "b")
    best = cut_lineage(near.groupBy(F.col("a").alias("node")).agg(F.min("rank")["node"].alias("center")))
    further = best.select(F.col("node").alias("center"), F.col("center").alias("next"))
    led = best.join(further, "center", "left").select("node", F.coalesce("next", "center").alias("center"))
    return sketches.select("node").join(led, "node", "left").select("node", F.coalesce("center", "node").alias("center"))


def solve_group(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all of the sets that are connected by pairs of at least the least similarity.

    |a ^ b| = |(a ^ core) ^ (b ^ core)|.  With ``far`` = |a ^ core| and ``own`` values
    of that in no other set, two differences differ in at least
    far_a + 2 own_b - far_b values, and in as many with a and b exchanged.
    """
    n = np.array(list(map(len, sets)))
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    codes, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    core = 2 * held > len(sets)
    per = lambda flags: np.add.reduceat(flags[codes].astype(np.int64), starts)
    far = n + int(core.sum()) - 2 * per(core)
    spare = 2 * per((held == 1) & ~core) - far
    share = (100 - percent) / (100 + percent)
    labels, links = np.arange(len(n)), []

    def compare(p: int, among: np.ndarray) -> None:
        mine = np.zeros(len(held), bool)
        mine[codes[starts[p] : starts[p] + n[p]]] = True
        if len(among) > len(n) // 4:
            both = per(mine)[among]
        else:
            both = np.array([np.count_nonzero(mine[codes[starts[b] : starts[b] + n[b]]]) for b in among])
        for b in among[100 * both >= percent * (n[p] + n[among] - both)]:
            if labels[b] != labels[p]:
                links.append((int(nodes[p]), int(nodes[b])))
                labels[labels == labels[b]] = labels[p]

    best = int(np.argmin(far - share * n))
    compare(best, np.flatnonzero(np.arange(len(n)) != best))
    main = np.bincount(labels).argmax()
    for p in np.flatnonzero(labels != main):
        most = share * (n[p] + n) + 1e-6
        fits = (labels != labels[p]) & (far[p] + spare <= most) & (far + spare[p] <= most) & (100 * np.minimum(n, n[p]) >= percent * np.maximum(n, n[p]))
        if fits.any():
            compare(p, np.flatnonzero(fits))
    return links


def _within(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within each part of each group ``placed(node, center, part, parts)``; the center takes part in every part."""
    others = placed.filter("node != center").select("node", "center", "part")
    leaders = others.select("center", "part").distinct().select(F.col("center").alias("node"), "center", "part")
    rows = others.unionAll(leaders).join(sets.select("node", "values"), "node").repartition("center", "part").sortWithinPartitions("center", "part", "node")

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        sets = [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in table.column("values")]
        links = solve_group(table.column("node").to_numpy(), sets, percent)
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(_by_group(("center", "part"), solve), "a long, b long")


def _by_group(keys: tuple[str, ...], solve: Callable) -> Callable:
    """A function of batches, ordered by ``keys``, that solves the rows of each key together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in keys]
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for x in columns:
                new[1:] |= x[1:] != x[:-1]
            starts = np.flatnonzero(new)
            for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                key = tuple(x[start] for x in columns)
                if held and key != last:
                    yield solve(held)
                    held = []
                held.append(batch.slice(start, stop - start))
                last = key
        if held:
            yield solve(held)

    return run


def _across(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Promising pairs (a, b) of one list, of other components and of other groups; ``nodes(node, label, center, part, n, own, sketch)``.

    Most of a list are often of one component, and are compared with the others only.  Blocks bound what a task holds.
    """
    labelled = lists.join(nodes.select("node", "label", "center", "part"), "node")
    each = labelled.groupBy("value", "label").agg(F.count("*").alias("c"), *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("center", "part")))
    differ = (F.min("min_center") != F.max("max_center")) | (F.min("min_part") != F.max("max_part"))
    split = each.groupBy("value").agg(F.max(F.struct("c", "label")).alias("main"), F.sum("c").alias("m"), F.count("*").alias("labels"), differ.alias("differ")).filter("labels > 1 AND differ")
    sizes = split.select("value", F.col("main.label").alias("main"), F.ceil(F.col("main.c") / BLOCK).cast("int").alias("mains"), F.ceil((F.col("m") - F.col("main.c")) / BLOCK).cast("int").alias("others"))
    placed = lists.join(sizes, "value").join(nodes, "node")
    other = F.col("label") != F.col("main")
    block = F.pmod(F.xxhash64("node"), F.when(other, F.col("others")).otherwise(F.col("mains")).cast("long")).cast("int")
    spot = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    upto = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    with_others = upto("others", lambda k: spot(0, F.least(k, "block"), F.greatest(k, "block")))
    spots = F.when(other, F.concat(with_others, upto("mains", lambda k: spot(1, k, F.col("block"))))).otherwise(upto("others", lambda k: spot(1, F.col("block"), k)))
    rows = placed.withColumn("block", block).withColumn("other", other).select("value", F.explode(spots).alias("s"), "block", "other", "node", "label", "center", "part", "n", "own", "sketch")
    rows = rows.select("value", "s.kind", "s.i", "s.j", *(c for c in rows.columns if c not in ("value", "s")))
    rows = rows.repartition("value", "kind", "i", "j").sortWithinPartitions("value", "kind", "i", "j", "n", "node")
    share = (100 - percent) / (100 + percent)

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(rows).combine_chunks()
        kind, i, j = (group.column(c)[0].as_py() for c in ("kind", "i", "j"))
        block, other, label, center, part, n, own, node = (group.column(c).to_numpy() for c in ("block", "other", "label", "center", "part", "n", "own", "node"))
        sketch, found = None, []
        for at in range(0, len(n), 128):
            p, q = (x.ravel() for x in np.meshgrid(np.arange(at, min(at + 128, len(n))), np.arange(at + 1, len(n)), indexing="ij"))
            use = (p < q) & (label[p] != label[q]) & ((center[p] != center[q]) | (part[p] != part[q])) & (100 * n[p] >= percent * n[q])
            # Values that no other set has are in one set of two only.  Pairs within a block belong to the spot (i, i).
            use &= (own[p] + own[q] <= share * (n[p] + n[q]) + 1e-6) & (other[p] != other[q] if kind else (i == j) | (block[p] != block[q]))
            p, q = p[use], q[use]
            for k in range(0, len(p), 4096):
                sketch = _padded(group.column("sketch").combine_chunks()) if sketch is None else sketch
                x, y = p[k : k + 4096], q[k : k + 4096]
                good = promising(sketch[x], sketch[y], n[x], n[y], percent)
                found.append((node[x[good]], node[y[good]]))
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return rows.mapInArrow(_by_group(("value", "kind", "i", "j"), solve), "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough: (a, b)."""
    pairs = cut_lineage(pairs)
    ids = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # a checked size
    used = sets.select("node", "values").join(F.broadcast(ids) if few else ids, "node", "left_semi")
    side = lambda x: used.select(F.col("node").alias(x), F.col("values").alias(f"{x}_values"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_values", "b_values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _labels(reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, label) of the nodes that are linked with others; ``reps(node, key, rep, rep_hash, n, sketch)``."""
    keys = cut_lineage(_keys(reps, percent))
    alive = keys.select("node").distinct().join(reps.select("node", "rep", "rep_hash", "key"), "node")
    sets = cut_lineage(_with_own(cut_lineage(_sets(docs, alive, words)), percent))
    sketches = sets.select("node", "n", "own", F.slice("values", 1, KEPT).alias("sketch"))
    lists = keys.join(sets.select("node"), "node", "left_semi")
    lists = cut_lineage(lists.join(lists.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1").select("value"), "value"))
    centred = cut_lineage(_centred(lists, sketches, percent))
    sizes = centred.join(sets.select("node", "n"), "node").groupBy("center").agg(F.sum("n").alias("total"))
    parts = F.ceil(F.col("total") / GROUP_VALUES)
    placed = cut_lineage(centred.join(sizes, "center").select("node", "center", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part")))
    links = cut_lineage(_within(placed, sets, percent))
    nodes = placed.join(components(links), "node", "left").select("node", F.coalesce("label", "node").alias("label"), "center", "part").join(sketches, "node")
    return components(links.unionAll(_confirmed(_across(lists, nodes, percent), sets, percent)))


def classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``near_duplicates`` with ``text_hash``, and ``first``: of the rows of each component those with its smallest id, or without any id those of one text."""
    signed = cut_lineage(signatures(docs, words))
    worded = signed.filter("n > 0")
    rank = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    found = worded.groupBy("key").agg(rank.alias("r"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = cut_lineage(found.select(F.monotonically_increasing_id().alias("node"), "key", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("rep_hash"), "n", "sketch"))
    named = cut_lineage(reps.select("node", "key", "rep", "rep_hash").join(_labels(reps, docs, words, percent), "node", "left").select("key", "rep", "rep_hash", F.coalesce("label", "node").alias("label")))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.min(F.when(F.col("rep").isNull(), F.col("rep_hash"))).alias("least_hash"))
    own = named.join(least, "label").select("key", "component_id", "least_hash")
    first = F.when(F.col("component_id").isNull(), F.col("text_hash") == F.col("least_hash")).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    out = worded.join(own, "key").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", first.alias("first"))
    bare = signed.filter("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return out.unionAll(bare)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Links documents whose sets of shingles have a Jaccard similarity of at
    least ``percent`` hundredths.  ``component_id`` is the smallest doc_id of the
    component, ``kept`` says that the document has it.  Texts without words
    (null, empty, blank) are linked with nothing.  Rows of one id with several
    texts are judged each by its text; rows without an id link others, but a null
    id is never the smallest and never kept.  Other columns are ignored; an
    empty table gives an empty result.
    """
    found = classes(docs, words, percent)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
