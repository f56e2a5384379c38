"""Cleaning lines: conversion, legality, verdicts and the removal of repeated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chars


def to_lines(docs: DataFrame, text: str = "text", *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per line: the kept columns, line_no from 0, line."""
    return docs.select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def judged(lines: DataFrame, *, least_length: int = 5, allowed: str | None = None, max_run: int | None = None, **limits) -> DataFrame:
    """Adds kept, han, illegal and verdict (ok, bad, err) to ``lines(line)``; lines under ``least_length`` UTF-16 units vanish."""
    long = lines.filter(chars.utf16_length(F.col("line")) >= least_length)
    # Bound by lambdas and put out by a generator: a filter above would otherwise repeat the conversion for each of its uses.
    one = F.transform(F.array(chars.convert(F.col("line"))), lambda t: F.struct(t.alias("t"), chars.first_illegal(t, allowed).alias("illegal"), chars.kept_text(t).alias("kept")))
    one = F.transform(one, lambda x: F.struct(x["t"].alias("t"), x["kept"].alias("kept"), chars.han_text(x["kept"]).alias("han"), x["illegal"].alias("illegal")))
    one = F.transform(one, lambda x: F.struct(x["kept"], x["han"], x["illegal"], chars.verdict(x["t"], x["illegal"], x["han"], x["kept"], max_run, **limits).alias("verdict")))
    return long.select("*", F.inline(one))


def illegal_histogram(judged_lines: DataFrame, top: int | None = None) -> DataFrame:
    """How often each character was the first illegal one of a line, most frequent first."""
    counts = judged_lines.filter("verdict = 'err'").groupBy("illegal").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "illegal")
    return counts if top is None else counts.limit(top)


def first_of(rows: DataFrame, key: str | Column, order: list[str]) -> DataFrame:
    """The first row of each key in the order of the columns; null keys count as one key.

    A minimum, not a window: it is aggregated before the shuffle, so a key with a
    large share of the rows costs no more than others.
    """
    key = F.col(key) if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in order]
    # Texts have long beginnings in common: sorted by a hash first, they are seldom compared.
    best = rows.groupBy(F.xxhash64(key).alias("__hash"), key.alias("__key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__row"))
    return best.select(*(F.col(f"__row.{c}").alias(c) for c in [*order, *rest])).select(*rows.columns)


def _firsts(every: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, Column]:
    """Where the first of equal good lines stand, and what joins them to the lines. The hash: as in ``first_of``."""
    best = every.filter("verdict = 'ok'").groupBy(F.xxhash64("han").alias("__hash"), "han").agg(F.min(F.struct(*order)).alias("__at"))
    same = F.lit(True)
    for c in order:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return best.select(*(F.col(f"__at.{c}").alias(f"__{c}") for c in order)), same


def filtered(lines: DataFrame, order: tuple[str, ...] = ("doc_id", "line_no"), **limits) -> DataFrame:
    """The four outcomes of every line: kept, repeat, bad, err.  Lines are repeats if their Han characters are those of an earlier line.

    ``order`` must tell all lines apart.  Only keys are joined, so that the lines are judged twice and texts shuffled once.
    """
    every = judged(lines, **limits)
    firsts, same = _firsts(every, order)
    rest = [c for c in every.columns if c != "verdict"]
    verdict = F.when(F.col("verdict") != "ok", F.col("verdict")).when(F.col("__first"), "kept").otherwise("repeat")
    return every.join(firsts.withColumn("__first", F.lit(True)), same, "left").select(*rest, verdict.alias("verdict"))


def repeats(lines: DataFrame, order: tuple[str, ...] = ("doc_id", "line_no"), **limits) -> DataFrame:
    """The good lines whose Han characters are those of an earlier one; no other line is shuffled."""
    every = judged(lines, **limits)
    firsts, same = _firsts(every, order)
    return every.filter("verdict = 'ok'").join(firsts, same, "left_anti").withColumn("verdict", F.lit("repeat"))
