"""Articles of an encyclopedia: sections, footnotes, titles, categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.documents import CATEGORY, CLOSE
from corpusloom.operators.lines import first_of


def cut_sections(lines: DataFrame, key: str = "doc_id", headings: tuple[str, ...] = T.CUT_HEADINGS) -> DataFrame:
    """Drops a document's lines from the first cut heading on, but for the closing mark and category lines.

    Lines are trimmed before; the window stays within a document.
    """
    line = T.trim(F.col("line"))
    so_far = W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    cut = F.max(line.isin(*headings).cast("int")).over(so_far) == 1
    stays = ~F.col("__cut") | (F.col("line") == CLOSE) | F.col("line").startswith(CATEGORY)
    return lines.withColumn("line", line).withColumn("__cut", cut).filter(stays).drop("__cut")


def strip_footnotes(lines: DataFrame) -> DataFrame:
    """Without bracketed notes; blank lines go before that, lines that become empty stay."""
    return lines.withColumn("line", T.trim(F.col("line"))).filter("line != ''").withColumn("line", T.without_footnotes(F.col("line")))


def distinct_titles(docs: DataFrame, order: list[str], simplified: tuple[str, str] | None = None) -> DataFrame:
    """The first document of each title, with the title, which comes from ``docs(url)``."""
    return first_of(docs.withColumn("title", T.title(F.col("url"), simplified)), "title", order)


def category_line(docs: DataFrame) -> DataFrame:
    """Adds the line that lists ``docs(categories)``."""
    return docs.withColumn("category_line", F.concat(F.lit(CATEGORY), F.array_join("categories", ",")))
