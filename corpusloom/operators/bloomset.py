"""The Bloom set as a table of set bits, for those who need the positions; exact joins serve everything else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import bloom


def add_all(texts: DataFrame, column: str, bits: int, k: int) -> DataFrame:
    """The set bits of all values: (bit)."""
    return texts.filter(F.col(column).isNotNull()).select(F.explode(bloom.positions(F.col(column), bits, k)).alias("bit")).distinct()


def contains(texts: DataFrame, column: str, held: DataFrame, bits: int, k: int) -> DataFrame:
    """Adds ``maybe`` to the distinct values of a column: whether all their bits are set."""
    values = texts.select(column).filter(F.col(column).isNotNull()).distinct()
    asked = values.select(column, F.explode(F.array_distinct(bloom.positions(F.col(column), bits, k))).alias("bit"))
    met = asked.join(held.withColumn("__set", F.lit(1)), "bit", "left")
    return met.groupBy(column).agg((F.count("__set") == F.count("*")).alias("maybe"))


def contains_all(texts: DataFrame, column: str, held: DataFrame, bits: int, k: int) -> bool:
    return contains(texts, column, held, bits, k).filter(~F.col("maybe")).isEmpty()


def filled(held: DataFrame, bits: int, k: int, added: int) -> dict[str, float]:
    """Set bits, their share, and the false-positive rates by the share and by the number of added values."""
    n = held.count()
    return {"bits_set": n, "share": n / bits, "rate_by_share": (n / bits) ** k, "rate_by_count": bloom.false_positive_rate(bits / max(1, added), k), "bits_per_element": bits / max(1, added)}
