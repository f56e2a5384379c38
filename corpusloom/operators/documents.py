"""Framed documents: reading the frames, joining lines again, gating by length, packing into parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.operators.order import numbered, running_sum

# The marks of a document's frame, and the marks of a category line.
OPEN, CLOSE, CATEGORY = "URL::", "END::", "Category::"
#: Characters of a part, least characters of a document, and sentences of a chunk.
PART_CHARS, LEAST_CHARS, CHUNK_ROWS = 30_000_000, 50, 300_000


def unframed(files: DataFrame) -> DataFrame:
    """Body lines of ``files(file, text)``: file, doc_no, url, line_no, line, closed.

    Text outside a frame is left out.  A document without its closing mark is
    kept and marked by ``closed`` = false.
    """
    lines = files.select("file", F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))
    by_file = W.partitionBy("file").orderBy("line_no")
    so_far = by_file.rowsBetween(W.unboundedPreceding, 0)
    opens, closes = F.col("line").startswith(OPEN), F.col("line") == CLOSE
    marked = lines.withColumn("doc_no", F.sum(opens.cast("long")).over(so_far)).withColumn("__closed", F.sum(closes.cast("long")).over(so_far))
    by_doc = W.partitionBy("file", "doc_no")
    docs = (
        marked.filter("doc_no > 0")
        .withColumn("url", F.max(F.when(opens, F.substring("line", len(OPEN) + 1, 1 << 30))).over(by_doc))
        .withColumn("__before", F.min("__closed").over(by_doc))
        .withColumn("closed", F.max("__closed").over(by_doc) > F.col("__before"))
    )
    body = ~opens & ~closes & (F.col("__closed") == F.col("__before"))
    return docs.filter(body).select("file", "doc_no", "url", F.col("line_no").cast("long").alias("line_no"), "line", "closed")


def framed(docs: DataFrame) -> DataFrame:
    """The framed text of every row of ``docs(url, text)``."""
    return docs.select(F.concat(F.lit(OPEN), F.coalesce("url", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(f"\n{CLOSE}")).alias("value"))


def reassembled(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """The lines of each document, joined in order, each with its line end, and their number."""
    return lines.groupBy(key).agg(
        F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"),
        F.count("*").alias("n_lines"),
    )


def gated(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """Adds n_chars of the body and a verdict: keep above ``least``, else discard; empty documents vanish."""
    sized = docs.withColumn("n_chars", F.length("text").cast("long")).filter("n_chars > 0")
    return sized.withColumn("verdict", F.when(F.col("n_chars") > least, "keep").otherwise("discard"))


def large_enough(docs: DataFrame, least_bytes: int = PART_CHARS) -> bool:
    """Whether the texts have at least so many bytes together; smaller sources are not packed by those who ask for it."""
    return (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) >= least_bytes


def packed_by_window(docs: DataFrame, size: str, order: list[str], limit: int = PART_CHARS) -> DataFrame:
    """Adds ``part`` from 1: where a document begins, in multiples of the limit.  Scales with the cluster; see ``packed_in_order`` for the other borders."""
    summed = running_sum(docs, order, F.col(size).cast("long"), "__sum")
    return summed.withColumn("part", F.floor((F.col("__sum") - F.col(size)) / limit) + 1).drop("__sum")


def packed_in_order(docs: DataFrame, shard: str, size: str, order: list[str], limit: int = PART_CHARS) -> DataFrame:
    """(shard, order, size, part): a part ends with the document by which it exceeds the limit; parts are numbered from 1 in each shard.

    The rule is sequential in a shard (as a source file is).  A shard's sizes
    stream through one task in constant memory; texts are not part of them.
    """
    rows = docs.select(shard, *order, F.col(size).cast("long").alias(size))
    names = rows.columns
    at = names.index(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, part, begun = None, 0, 1, False
        for batch in batches:
            parts = []
            for own, n in zip(batch.column(0).to_pylist(), batch.column(at).to_pylist(), strict=True):
                if not begun or own != now:
                    now, total, part, begun = own, 0, 1, True
                parts.append(part)
                total += n or 0
                if total > limit:
                    total, part = 0, part + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.int64())], names=[*names, "part"])

    kinds = rows.withColumn("part", F.lit(0).cast("long")).schema
    return rows.repartition(shard).sortWithinPartitions(shard, *order).mapInArrow(run, kinds)


def batches(rows: DataFrame, order: list[str], n: int = CHUNK_ROWS, first: int = 0, name: str = "chunk") -> DataFrame:
    """Adds the number of the batch of ``n`` rows, from ``first``, in the order of the columns."""
    return numbered(rows, order, "__n").withColumn(name, F.floor((F.col("__n") - 1) / n) + first).drop("__n")
