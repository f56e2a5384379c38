"""Archives of raw pages: ``<n>\\n<url>\\n<html of n UTF-16 units>``, one after another in a file."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chars, urls

PAGES = "src_file string, url string, html string"


#: So many bytes are decoded at once.
CHUNK = 1 << 20


def records(data: bytes, encoding: str = "utf-8") -> Iterator[tuple[str, str]]:
    """(url, html) of every record.  A last record that is cut short gives what there is of it.

    Beside ``data`` (any buffer) only a chunk or the record at hand is held.
    """
    decoder, view = codecs.getincrementaldecoder(encoding)(), memoryview(data)
    units, at, read = bytearray(), 0, 0
    line_end = "\n".encode("utf-16-le")

    def more() -> bool:
        """Decodes the next chunk; what has been read goes."""
        nonlocal at, read
        if read > len(view):
            return False
        del units[:at]
        at, last = 0, read + CHUNK >= len(view)
        units.extend(decoder.decode(bytes(view[read : read + CHUNK]), last).encode("utf-16-le", "surrogatepass"))
        read = len(view) + 1 if last else read + CHUNK
        return True

    def line() -> bytes | None:
        nonlocal at
        sought = 0
        while True:
            stop = at + sought
            while (stop := units.find(line_end, stop)) % 2 and stop >= 0:
                stop += 1
            if stop >= 0:
                text, at = bytes(units[at:stop]), stop + 2
                return text
            sought = len(units) - at
            if not more():
                return None

    while at < len(units) or more():
        if at == len(units):
            continue
        size, url = line(), line()
        if size is None or url is None:
            return
        count = size.decode("utf-16-le").strip()
        if not count.isascii() or not count.isdigit():
            raise ValueError(f"not an archive: {count[:40]!r} where a size should be")
        while len(units) - at < 2 * int(count) and more():
            pass
        stop = min(len(units), at + 2 * int(count))
        yield url.decode("utf-16-le"), units[at:stop].decode("utf-16-le", "replace")
        at = stop


def read_archives(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """All records of all files below a path: src_file, url, html.  Files can't be split: one task a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, content in zip(batch.column(0), batch.column(1), strict=True):
                held, size = [], 0
                for url, html in records(content.as_buffer(), encoding):
                    held.append((path_.as_py(), url, html))
                    size += len(html)
                    if size > 4_000_000:
                        yield _batch(held)
                        held, size = [], 0
                yield _batch(held)

    return files.mapInArrow(run, PAGES)


def _batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["src_file", "url", "html"])


def read_single_records(spark: SparkSession, path: str) -> DataFrame:
    """Files of one record each: src_file, url, html."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("src_file"), "value")
    whole = r"(?s)^(\d+)\n([^\n]*)\n(.*)$"
    return text.filter(F.col("value").rlike(whole)).select("src_file", F.regexp_extract("value", whole, 2).alias("url"), F.regexp_extract("value", whole, 3).alias("html"))


def to_records(pages: DataFrame) -> DataFrame:
    """The framed record of every page of ``pages(url, html)``, without its last line end.

    The size counts UTF-16 units and that line end, which a text writer adds:
    so records follow one another without anything between.
    """
    html = F.coalesce("html", F.lit(""))
    return pages.select(F.concat((chars.utf16_length(html) + 1).cast("string"), F.lit("\n"), "url", F.lit("\n"), html).alias("value"))


def write_archives(pages: DataFrame, path: str, store_parsed: bool = True) -> None:
    """Parquet by ``parsed`` and ``batch``; parsed pages only if they are wanted."""
    kept = pages.filter(F.lit(store_parsed) | ~F.col("parsed"))
    kept.withColumn("file_name", urls.file_name(F.col("url"))).write.mode("append").partitionBy("parsed", "batch").parquet(path)
