"""Batches of bounded memory, names that a table does not have yet, and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.order import cut_lineage


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what is made of a batch need not be held at once; at the end unused memory is given back."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)
    given_back()


def given_back() -> None:
    """Gives the memory that Arrow and the C library hold unused back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


_sole: list = []


def sole(build: Callable) -> Callable:
    """Remembers the last value that ``build`` gave in this process, and forgets that of any other function with this mark.

    Python workers outlive their stage: else they would hold the tables of all stages that they have served.
    """

    @wraps(build)
    def value(*args):
        if not _sole or _sole[:2] != [build, args]:
            _sole.clear()
            given_back()
            _sole[:] = [build, args, build(*args)]
        return _sole[2]

    return value


def unused(names: list[str], taken: list[str]) -> list[str]:
    """The names, with underscores after those that a table already has."""
    held, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``: the smallest node that it is connected with.

    Alternates the large-star and the small-star step, so that the number of
    rounds grows with the logarithm of a component's size.  Links stay
    distributed; a hot node's links are only aggregated by minimum and joined.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    before = None
    while True:
        # Every neighbour above a node is tied to the smallest neighbour of that node.
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every neighbour below a node, and the node, are tied to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots)
