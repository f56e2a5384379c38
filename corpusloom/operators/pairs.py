"""Bilingual pages: both languages of one article, joined by the key in their URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls

#: The pattern whose group is the key, and what stands before the key in the other language's URL.
SLUG_PATTERN = r"http://techcrunch.cn/\d{4}/\d{2}/\d{2}/([^/]+)"
OTHER_PREFIX = "http://techcrunch.com/"


def by_slug(pages: DataFrame, others: DataFrame, pattern: str = SLUG_PATTERN, prefix: str = OTHER_PREFIX) -> DataFrame:
    """(url_zh, text_zh, url_en, text_en) of ``pages(url, text)`` and ``others(url, text)``; both texts must be there."""
    keyed = pages.select(F.col("url").alias("url_zh"), F.col("text").alias("text_zh"), F.concat(F.lit(prefix), urls.group(F.col("url"), pattern)).alias("url_en"))
    right = others.select(F.col("url").alias("url_en"), F.col("text").alias("text_en"))
    return keyed.filter("text_zh is not null and url_en is not null").join(right.filter("text_en is not null"), "url_en").select("url_zh", "text_zh", "url_en", "text_en")


def without_partner(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    return pages.join(pairs.select(F.col("url_zh").alias("url")), "url", "left_anti")
