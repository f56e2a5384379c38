"""Queries over the Bloom set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import bloom
from corpusloom.operators import bloomset
from corpusloom.plans.registry import query

BITS, HASHES = 100_003, 14

_POSITIONS = f"""hashed AS (SELECT page_id, url, list_transform(range({HASHES}), lambda i: CAST('0x' || substr(md5(unhex(printf('%02x', i // 4)) || encode(url)), CAST(8 * (i % 4) + 1 AS INTEGER), 8) AS BIGINT)) AS h FROM pages WHERE url IS NOT NULL),
placed AS (SELECT page_id, url, list_transform(h, lambda x: abs((CASE WHEN x >= 2147483648 THEN x - 4294967296 ELSE x END) % {BITS})) AS positions FROM hashed)"""


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet").filter("url is not null").select("page_id", "url")


@query(f"WITH {_POSITIONS} SELECT page_id, array_to_string(positions, ',') AS positions FROM placed")
def bloom_positions(spark: SparkSession, folder: str) -> DataFrame:
    """The bits that each url sets."""
    found = F.transform(bloom.positions(F.col("url"), BITS, HASHES), lambda x: x.cast("string"))
    return _pages(spark, folder).select("page_id", F.array_join(found, ",").alias("positions"))


@query(f"""WITH {_POSITIONS}, held AS (SELECT DISTINCT unnest(positions) AS bit FROM placed WHERE page_id % 2 = 0),
asked AS (SELECT url, unnest(list_distinct(positions)) AS bit FROM (SELECT DISTINCT url, positions FROM placed))
SELECT a.url, count(h.bit) = count(*) AS maybe FROM asked a LEFT JOIN held h ON a.bit = h.bit GROUP BY a.url""")
def bloom_contains(spark: SparkSession, folder: str) -> DataFrame:
    """All urls against a set of the even pages': of BITS bits as its SQL has it, or as many more as the counted urls need."""
    pages = _pages(spark, folder)
    even = pages.filter("page_id % 2 = 0")
    n = even.select("url").distinct().count()
    bits = max(BITS, bloom.size(bloom.for_rate(2.0**-HASHES, n)[0], n, saturate=True))
    return bloomset.contains(pages, "url", bloomset.add_all(even, "url", bits, HASHES), bits, HASHES)


@query(f"SELECT count(*) AS n, round(pow(1 - exp(-{HASHES} * count(*) / CAST({BITS} AS DOUBLE)), {HASHES}), 9) AS rate FROM pages WHERE url IS NOT NULL")
def bloom_fpp(spark: SparkSession, folder: str) -> DataFrame:
    """The false-positive rate after all urls have been added."""
    n = _pages(spark, folder).agg(F.count("*").alias("n"))
    return n.select("n", F.round(bloom.rate(F.lit(BITS), F.lit(HASHES), F.col("n")), 9).alias("rate"))
