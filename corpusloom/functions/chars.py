"""Characters of a line: conversion, legality, Han share and verdict, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that are replaced, each by the character at the same place below it.
CONVERT_FROM = (
    "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
    "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ"
    "０１２３４５６７８９"
    "―－─％～〜()＂“”●∶＝＋／÷○⋯×｜"
    "\x7f．\uf8f5\xa0\u3000\uf06c\uf0d8\uf06e\uf075\uf0a7\uf09f\uf0b2\uf0fc\uf020\ue805\uf0a0\uf02d\ue774\uf0b7\uf076\ue803\u200a\ufeff\ue4c7"
    "★■▲□・•"
)
CONVERT_TO = (
    "abcdefghijklmnopqrstuvwxyz"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "0123456789"
    '———%~~（）"""·:=+//零…x|'
    " .                      "
    "······"
)
#: Single legal characters beside letters, digits and the three blocks of punctuation.
LEGAL = "·~!℃@#$%^&*()_+{}|:\"<>?-=[]\\;',./"
#: Blanks that are dropped from a kept line.
SPACES = " \t\n\b\f\r"
#: Least Han characters (exclusive), least share (exclusive), Han characters beyond which the share doesn't count.
LEAST_HAN, LEAST_SHARE, MANY_HAN = 5, 0.7, 50
#: Fixed value: so many NULs make a line bad.
NULS = 5

HAN = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}"
#: All other characters.  Java takes several times as long for the same set written as ``[^HAN]``.
NOT_HAN = r"\x{0}-\x{33FF}\x{4DC0}-\x{4DFF}\x{A000}-\x{F8FF}\x{FB00}-\x{10FFFF}"
PUNCTUATION_BLOCKS = r"\x{3000}-\x{303F}\x{FF00}-\x{FFEF}\x{2000}-\x{206F}"
BEYOND_BMP = r"\x{10000}-\x{10FFFF}"


def escaped(chars: str) -> str:
    """Characters as they stand in a character class, for Java's and RE2's dialect."""
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


def char_class(letters: str = r"\p{IsAlphabetic}", legal: str = LEGAL) -> str:
    """The inside of the class of allowed characters; SQL engines without ``IsAlphabetic`` give another class of letters."""
    return letters + r"\p{Nd}" + HAN + PUNCTUATION_BLOCKS + escaped(legal + SPACES + "\0")


def checked_map(lines: list[str]) -> tuple[str, str]:
    """A conversion table of two-character lines as (from, to); anything else is an error."""
    pairs = [x for x in lines if x]
    if any(len(x) != 2 for x in pairs):
        raise ValueError("a line of a conversion table has two characters")
    known = dict(x for x in pairs)  # the last of repeated keys counts
    return "".join(known), "".join(known.values())


def char_set(lines: list[str]) -> str:
    """All characters of all lines, each once."""
    return "".join(dict.fromkeys("".join(lines)))


def convert(line: Column, source: str = CONVERT_FROM, target: str = CONVERT_TO) -> Column:
    return F.translate(line, source, target)


def first_illegal(converted: Column, allowed: str | None = None) -> Column:
    """The first character that is not allowed, or empty; characters beyond the BMP never are."""
    return F.regexp_extract(converted, f"[^{allowed or char_class()}]|[{BEYOND_BMP}]", 0)


def kept_text(converted: Column) -> Column:
    return F.regexp_replace(converted, f"[{escaped(SPACES + chr(0))}]", "")


def han_text(kept: Column) -> Column:
    return F.regexp_replace(kept, f"[{NOT_HAN}]", "")


def nul_position(converted: Column) -> Column:
    """Where the fifth NUL stands (from 1), or 0."""
    return F.when(converted.contains("\0"), F.length(F.regexp_extract(converted, r"(?s)^((?:[^\x00]*\x00){%d})" % NULS, 1))).otherwise(0)


def legal_share(han: Column, kept: Column, least: int = LEAST_HAN, share: float = LEAST_SHARE, many: int = MANY_HAN) -> Column:
    """More than ``least`` Han characters, and either more than ``many`` or a share above ``share`` in single precision."""
    n, size = F.length(han), F.length(kept)
    ratio = F.try_divide(n.cast("float"), size.cast("float")).cast("float")
    return (n > least) & ((n > many) | F.coalesce(ratio > F.lit(share).cast("float"), F.lit(False)))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, as the archive framing counts."""
    return F.length(text) + F.regexp_count(text, F.lit(f"[{BEYOND_BMP}]"))


def equal_run(text: Column, n: int = 5) -> Column:
    """Whether some character stands ``n`` times in a row."""
    return text.rlike(r"(?s)(.)\1{%d,}" % (n - 1))


def verdict(converted: Column, illegal: Column, han: Column, kept: Column, max_run: int | None = None, **limits) -> Column:
    """``bad``: too many NULs or too small a Han share (or, if asked for, a run of equal characters); ``err``: an illegal character comes first; else ``ok``."""
    nuls = nul_position(converted)
    early = (nuls > 0) & ((illegal == "") | (nuls < F.instr(converted, illegal)))
    out = F.when(early, "bad").when(illegal != "", "err")
    if max_run is not None:
        out = out.when(equal_run(kept, max_run), "bad")
    return out.when(legal_share(han, kept, **limits), "ok").otherwise("bad")
