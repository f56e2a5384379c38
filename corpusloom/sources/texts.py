"""Text files as tables, and tables as text files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chars
from corpusloom.operators.documents import framed, unframed


def read_whole(spark: SparkSession, path: str, *, recursive: bool = True, glob: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """(file, text) of every file below a path, or of those in it that a glob fits."""
    options = {"recursiveFileLookup": recursive} | ({"pathGlobFilter": glob} if glob else {})
    raw = spark.read.format("binaryFile").options(**options).load(path).select("path", "content")
    if encoding.upper() in ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16"):
        return raw.select(F.col("path").alias("file"), F.decode("content", encoding).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = [x.as_py().decode(encoding, "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.string())], names=["file", "text"])

    return raw.mapInArrow(run, "file string, text string")


def read_framed(spark: SparkSession, path: str, **how) -> DataFrame:
    """Body lines of the framed documents in files: file, doc_no, url, line_no, line, closed."""
    return unframed(read_whole(spark, path, **how))


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct urls of files with one in each line."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(F.trim("value").alias("url")).filter("url != ''").distinct()


def read_char_table(spark: SparkSession, path: str) -> tuple[str, str]:
    """A conversion table of two-character lines; a configuration file, read whole."""
    return chars.checked_map([r.value for r in spark.read.text(path).collect()])


def read_char_set(spark: SparkSession, path: str) -> str:
    return chars.char_set([r.value for r in spark.read.text(path).collect()])


def write_framed(docs: DataFrame, path: str) -> None:
    framed(docs).write.mode("append").text(path)


def write_verdicts(lines: DataFrame, path: str) -> None:
    """Lines by verdict: one folder each for kept, repeated, bad and illegal ones."""
    lines.write.mode("append").partitionBy("verdict").parquet(path)


def write_histogram(counts: DataFrame, path: str) -> None:
    """``c=count`` lines, most frequent first."""
    counts.select(F.concat("illegal", F.lit("="), F.col("n").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_parts(docs: DataFrame, path: str) -> None:
    """Documents by part; rows of a part may lie in several files."""
    docs.write.mode("append").partitionBy("part").parquet(path)


def write_status(urls_: DataFrame, path: str) -> None:
    """The log of urls by status: visited, failed, rejected, date_rejected."""
    urls_.write.mode("append").partitionBy("status").parquet(path)


def write_metrics(spark: SparkSession, job: str, values: dict[str, int], path: str) -> None:
    """Appends what a job has counted (as of ``Observation.get``) as rows: ts, job, name, value."""
    rows = spark.createDataFrame([(job, k, int(v)) for k, v in sorted(values.items())], "job string, name string, value long")
    rows.select(F.current_timestamp().alias("ts"), "*").write.mode("append").parquet(path)
