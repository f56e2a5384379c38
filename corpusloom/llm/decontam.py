"""Benchmark decontamination with DataFrame operations only (operator 8).

A set join of item-sized windows with documents.  Of the words of a window only
the rarest, by the documents' own counts, is joined with the words of the
documents (for containment of the whole window a prefix of one word is enough);
its place in the window gives the place where the window would stand, which
must lie inside the document, and there all words are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import unused
from corpusloom.operators.order import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that no word holds: all but digits and letters.
APART = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Rows and bytes up to which benchmark words, or windows by word, are broadcast; more are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20


def words(text: Column) -> Column:
    """Lower-cased words; an empty array for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + APART, LOWER + " " * len(APART))
    return F.array_remove(F.split(plain, " "), "")


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows with the items that have them: (window, items)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    every = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window"))
    return every.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))


def _small(df: DataFrame, size: Column) -> DataFrame:
    """Marked for a broadcast if rows and bytes are few, which is checked."""
    found = df.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if found.n <= BROADCAST_ROWS and found["size"] <= BROADCAST_BYTES else df


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 8, least: int = 2, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Every row is judged by its own text, also if its id is null or another row's.
    Null and empty texts have no words; an empty benchmark hits nothing; items
    of null or empty text have no window; repeated items count by their id, and
    null ids not at all.  With ``keep``, these columns of ``docs`` come instead of
    doc_id, and added columns whose names they have end in an underscore; else other
    columns are ignored.
    """
    parts = windows(benchmark, size)
    own = parts.select(F.explode("window").alias("word")).distinct()

    names = keep or ["doc_id"]
    held = F.struct(*(F.col(f"`{c}`") for c in names), *([] if "text" in names else ["text"])).alias("row")
    whole = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), held)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    # Not explode: for that the optimizer adds a filter of texts without words, which cuts them a second time.
    each = texts.select("doc_id", "text_hash", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    counted = texts.select(F.explode_outer("words").alias("word")).join(_small(own, F.octet_length("word")), "word", "left_semi").groupBy("word").agg(F.count("*").alias("df"))

    inside = parts.select("window", "items", F.size("window").alias("length"), F.posexplode("window").alias("at", "word"))
    rated = inside.join(counted, "word", "left")
    rarest = rated.groupBy("window").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word", "at")).alias("key"), F.first("items").alias("items"), F.first("length").alias("length"))
    # A window with a word that no document has cannot occur.
    anchors = rarest.filter(F.col("key.df") > 0).select(F.col("key.word").alias("word"), F.col("key.at").alias("at"), "length", "window", "items")
    by_word = cut_lineage(anchors.groupBy("word").agg(F.collect_list(F.struct("at", "length", "window", "items")).alias("wanted")))
    length = lambda strings: F.aggregate(strings, F.lit(0), lambda n, x: n + F.octet_length(x) + 16)
    wanted = _small(by_word, F.aggregate("wanted", F.lit(0), lambda n, w: n + length(w["window"]) + length(w["items"]) + 64))

    near = each.join(wanted, "word")
    possible = near.select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"),
        F.explode(F.filter("wanted", lambda w: (F.col("pos") >= w["at"]) & (F.col("pos") - w["at"] + w["length"] <= F.col("n_words")))).alias("w"), "pos",
    )
    listed = possible.groupBy("id", "hash").agg(F.collect_set(F.struct((F.col("pos") - F.col("w.at") + 1).alias("start"), "w.length", "w.window", "w.items")).alias("candidates"))
    # Texts are shuffled as they are: arrays of words would be several times as large.
    joined = whole.join(listed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    none = F.filter("candidates", lambda c: F.lit(False))
    # The words are bound by a lambda: as a column, the optimizer would put their cutting into the filter, for every candidate.
    cut = F.transform(
        F.array(words(F.col("row.text"))),
        lambda held: F.struct(F.size(held).cast("long").alias("n_words"), F.coalesce(F.filter("candidates", lambda c: F.slice(held, c["start"], c["length"]) == c["window"]), none).alias("found")),
    )
    hits = joined.select("row", cut[0].alias("hit")).select("row", F.col("hit.n_words").alias("n_words"), F.col("hit.found").alias("found"))
    places = F.array_distinct(F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda c: c["items"]))))
    out = hits.select("row", "n_words", F.when(F.col("found").isNull(), 0).otherwise(F.size(places)).cast("long").alias("n_hit"), F.coalesce(items, F.array().cast("array<string>")).alias("items"))
    n = F.size("items").cast("long")
    added = unused(["n_words", "n_hit", "n_items", "items_sha256", "contaminated"], names)
    values = [F.col("n_words"), F.col("n_hit"), n, F.sha2(F.array_join("items", ","), 256), n >= least]
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in names), *(v.alias(c) for v, c in zip(values, added, strict=True)))
