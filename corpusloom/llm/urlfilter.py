"""URL rules and a listing of canonical URLs (operator 1).

Hosts and paths are cut out of the URLs, the longest fitting rule decides, and
what no rule fits is blocked if its canonical form is listed.  The listing may
be as large as the data: a blocked Bloom filter of it lets through the URLs that
may be listed, and only these meet the listing in an exact hash join, which
removes the false positives.  The filter grows with the listing; up to
BROADCAST_BLOCKS it is broadcast, beyond it is joined by block.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a block, and the bits that a key sets in its block.
BLOCK_BITS, KEY_BITS = 256, 6
#: Blocks of a filter that is broadcast, at most (8 MiB of bits).
BROADCAST_BLOCKS = 1 << 18
#: Rules up to which they are tried one by one; more are looked up by host.
TRIED_RULES = 200


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.org/es/")``: the host up to the first slash, the path from it."""
    if verdict not in ("allow", "block") or "/" not in text:
        raise ValueError(f"not a rule: {verdict} {text}")
    host, _, path = text.partition("/")
    return Rule(verdict, host.lower(), f"/{path}")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without slashes at its end; null without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, "/+$", "")))


def ruled(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.  Of equally long rules the first by text decides, of the same text the last given."""
    last = {r.text: r for r in rules}
    ordered = sorted(last.values(), key=lambda r: (-len(r.text), r.text))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    as_struct = lambda r: F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
    if len(ordered) <= TRIED_RULES:
        found = none
        for r in reversed(ordered):
            fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
            found = F.when(fits, as_struct(r)).otherwise(found)
        return found
    by_host: dict[str, list[str]] = {}
    for place, r in enumerate(ordered):
        by_host.setdefault(r.host, []).append(f"{place:09d}{r.verdict:5s}{r.path}")
    table = F.from_json(F.lit(json.dumps(by_host)), "map<string,array<string>>")
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    rows = F.flatten(F.filter(F.transform(hosts, lambda h: F.try_element_at(table, h)), lambda x: x.isNotNull()))
    fitting = F.filter(rows, lambda r: F.startswith(path, F.substr(r, F.lit(15))))
    best = F.array_min(fitting)  # the lowest place
    texts = F.from_json(F.lit(json.dumps([r.text for r in ordered])), "array<string>")
    return F.when(best.isNotNull(), F.struct(F.element_at(texts, F.substr(best, F.lit(1), F.lit(9)).cast("int") + 1).alias("rule"), F.rtrim(F.substr(best, F.lit(10), F.lit(5))).alias("verdict"))).otherwise(none)


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, and for each of the block's four words the bits that it sets."""
    hashed, other = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    words = [F.lit(0).cast("long")] * 4
    for i in range(KEY_BITS):
        at = F.shiftright(other, 8 * i).bitwiseAND(BLOCK_BITS - 1)
        bit = F.expr("1L").cast("long")
        bit = F.call_function("shiftleft", bit, at.bitwiseAND(63).cast("int"))
        word = F.shiftright(at, 6)
        words = [w.bitwiseOR(F.when(word == n, bit).otherwise(F.lit(0).cast("long"))) for n, w in enumerate(words)]
    return F.pmod(hashed, F.lit(blocks)), words


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocks that have bits: (block, w0..w3), at most ``blocks`` rows."""
    block, words = _place(F.col(key), blocks)
    one = listed.select(block.alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words)))
    return one.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)))


def blocks_for(keys: int) -> int:
    """A power of two with about 16 bits for each key."""
    return 1 << max(4, (max(1, keys) * 16 // BLOCK_BITS).bit_length())


def url_verdicts(pages: DataFrame, rules: list[Rule], listed: DataFrame, *, keys: int) -> DataFrame:
    """Judges ``pages(page_id, url)`` by rules and by ``listed(canonical)``.

    ``keys``: about how many URLs are listed, for the size of the filter; a
    wrong number costs time, never a wrong verdict.  Returns page_id, host,
    path, rule, verdict, canonical.  A null URL and one without ``://`` have
    empty host and path, no rule, no canonical form, and are allowed.  Repeated
    rows stay; other columns are ignored; an empty or null listing blocks none.
    """
    blocks = blocks_for(keys)
    listed = listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct()
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = ruled(F.col("host"), F.col("path"), rules)
    judged = parts.select("page_id", "host", "path", found.alias("found"), canonical(F.col("host"), F.col("path")).alias("canonical"))
    block, words = _place(F.col("canonical"), blocks)
    keyed = judged.select("*", block.alias("block"), *(w.alias(f"k{i}") for i, w in enumerate(words)))
    filled = bloom(listed, "canonical", blocks)
    filled = F.broadcast(filled) if blocks <= BROADCAST_BLOCKS else filled  # no more rows than blocks
    within = F.lit(True)
    for i in range(4):
        within &= F.col(f"k{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"k{i}")
    probed = keyed.join(filled, "block", "left").withColumn("maybe", F.coalesce(within & F.col("canonical").isNotNull() & F.col("found").isNull(), F.lit(False)))
    sure = probed.filter(~F.col("maybe")).select("page_id", "host", "path", "found", "canonical", F.lit(False).alias("hit"))
    exact = (
        probed.filter("maybe")
        .select("page_id", "host", "path", "found", "canonical")
        .join(listed.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
        .select("page_id", "host", "path", "found", "canonical", F.coalesce("listed", F.lit(False)).alias("hit"))
    )
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("hit"), "block").otherwise("allow"))
    return sure.unionAll(exact).select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "canonical")
