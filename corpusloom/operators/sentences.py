"""Sentences: splitting, removal of repeats, tags."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.functions import text as T
from corpusloom.operators.lines import first_of

#: Fixed value: the source that a tag names.
SOURCE = "wikipedia"


def split_sentences(lines: DataFrame, keep: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """One row per sentence of ``lines(line)``: the kept columns, sent_no from 0, sentence."""
    return lines.select(*keep, F.posexplode(T.sentences(F.col("line"))).alias("sent_no", "sentence")).withColumn("sent_no", F.col("sent_no").cast("long"))


def distinct_sentences(sentences: DataFrame, order: tuple[str, ...] = ("doc_id", "line_no", "sent_no")) -> DataFrame:
    """The first of equal sentences; sentences of one character are left out, empty ones are not."""
    trimmed = sentences.withColumn("sentence", T.trim(F.col("sentence"))).filter(F.length("sentence") != 1)
    return first_of(trimmed, "sentence", list(order))


def tagged(sentences: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sentences with title, categories (joined by ``|``; null without any) and source of their documents ``docs(title, categories)``."""
    about = docs.select(key, "title", F.when(F.size("categories") > 0, F.array_join("categories", "|")).alias("categories"))
    return sentences.join(about, key).withColumn("source", F.lit(SOURCE))


def zipped(sentences: DataFrame, tags: DataFrame) -> DataFrame:
    """Joins sentence n of a file with its four tag lines: ``sentences(file, n, sentence)``, ``tags(file, n, line)``, both numbered from 0."""
    four = tags.withColumn("__n", F.floor(F.col("n") / 4)).groupBy("file", F.col("__n").alias("n"))
    part = lambda i, name: F.max(F.when(F.col("n") % 4 == i, F.col("line"))).alias(name)
    return sentences.join(four.agg(part(0, "title"), part(1, "categories"), part(2, "source")), ["file", "n"])


def quotations(lines: DataFrame, keep: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """One row per quotation of ``lines(line)``."""

    @F.pandas_udf(ArrayType(StringType()))
    def spans(line: pd.Series) -> pd.Series:
        return line.map(T.quote_spans)

    likely = lines.filter(F.col("line").rlike("[" + T.escaped(T.OPENING + "(") + "]"))
    return likely.select(*keep, F.posexplode(spans("line")).alias("span_no", "span"))
