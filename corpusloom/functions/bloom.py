"""A salted-MD5 Bloom set: sizing, bit positions, false-positive rates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def for_rate(rate: float, elements: int) -> tuple[float, int]:
    """(bits an element, hashes) for a wanted false-positive rate."""
    k = math.ceil(-math.log2(rate))
    return k / math.log(2), k


def for_bits(bits: int, elements: int) -> int:
    """Hashes for a set of so many bits: the nearest whole number to the best."""
    return math.floor(bits / elements * math.log(2) + 0.5)


def size(bits_per_element: float, elements: int, saturate: bool = False) -> int:
    """Bits of the set; with ``saturate`` never above 2^31 - 1, as a set indexed by 32-bit integers has."""
    bits = math.ceil(bits_per_element * elements)
    return min(bits, 2**31 - 1) if saturate else bits


def false_positive_rate(bits_per_element: float, hashes: int, share: float = 1.0) -> float:
    """The rate when ``share`` of the expected elements are in."""
    return (1 - math.exp(-hashes * share / bits_per_element)) ** hashes


def rate(bits: Column, hashes: Column, elements: Column) -> Column:
    return F.pow(1 - F.exp(-hashes * elements / bits.cast("double")), hashes)


def hashes(text: Column, k: int) -> Column:
    """``k`` signed 32-bit hashes: each MD5 of a salt byte and the UTF-8 text gives four."""
    data = F.encode(text, "UTF-8")
    parts = []
    for salt in range(-(-k // 4)):
        digest = F.md5(F.concat(F.unhex(F.lit(f"{salt:02x}")), data))
        for i in range(min(4, k - 4 * salt)):
            word = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
            parts.append(F.when(word >= 2**31, word - 2**32).otherwise(word))
    return F.array(*parts)


def positions(text: Column, bits: int, k: int) -> Column:
    return F.transform(hashes(text, k), lambda h: F.abs(h % F.lit(bits).cast("long")))
