"""Lines and sentences as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.chars import escaped

# Ends of sentences, and what may follow them within the sentence, at most two.
TERMINALS = "。？！；"
ABSORBED = "!\"#$%&')*+,-./:;=>?@]}^_`|~£§­®°³´‑–—―’”•…′″₤€、。〉》・！＃％＆）】＋，．：；？"
#: Headings that end the main text of an article.
CUT_HEADINGS = ("相关条目", "外部链接", "外部连接", "参考资料", "参考文献", "延伸阅读", "参见", "相关项目", "参考")
#: Fixed value: what stands before the title in an article's URL.
TITLE_MARK = "/zh-cn/"
SENTENCE_PATTERN = f"([{TERMINALS}][{escaped(ABSORBED)}]{{0,2}})"


def trim(text: Column) -> Column:
    """Without any characters up to the blank at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def sentences(line: Column) -> Column:
    """The sentences of a line, with wide parentheses; none of an empty line."""
    marked = F.regexp_replace(F.translate(line, "()", "（）"), SENTENCE_PATTERN, "$1\n")
    return F.filter(F.split(marked, "\n"), lambda s: s != "")


def without_footnotes(line: Column) -> Column:
    return F.regexp_replace(line, r"\[.*?]", "")


def title(url: Column, simplified: tuple[str, str] | None = None) -> Column:
    """What follows the mark in a decoded URL; without the mark all but six characters."""
    plain = F.coalesce(F.try_url_decode(url), url)
    if simplified is not None:
        plain = F.translate(plain, *simplified)
    return F.substring(plain, F.locate(TITLE_MARK, plain) + F.lit(len(TITLE_MARK)), F.length(plain))


def simplified_table(spark, chars: str) -> tuple[str, str]:
    """For ``translate``: those of the given characters that ICU (which Spark ships) writes otherwise in simplified script."""
    to = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    pairs = [(c, to.transliterate(c)) for c in dict.fromkeys(chars)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def after_double_colon(line: Column) -> Column:
    """The second part of a line at ``::``, or null."""
    return F.try_element_at(F.split(line, "::"), F.lit(2))


def batch_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


# Opening marks with the marks that close them, marks that make a span a quotation, and lengths.
OPENING = "“‘﹄『「﹂（【〔《〈﹏[{'\""
CLOSING = "”’﹃』」﹁）】]》〉﹏]}'\""
INNER = "、。，：；？！》）”’】"
LONG_WITH_MARK, LONG = 7, 22


def quote_span(line: str, at: int) -> tuple[str, int] | None:
    """The quotation that opens at a place of a line, and the place of its last character; none if it isn't one.

    Nested marks of the same kind are balanced; up to two absorbed marks after
    the closing one belong to the span.  A mark that closes itself never closes.
    """
    if line[at : at + 1] not in OPENING + "(":  # most places; the empty text is caught below
        return None
    text = line.translate({40: "（", 41: "）"})
    kind = OPENING.find(text[at : at + 1]) if at < len(text) else -1
    if kind < 0:
        return None
    opening, closing = OPENING[kind], CLOSING[kind]
    depth, marked = 0, False
    for end in range(at, len(text)):
        c = text[end]
        depth += 1 if c == opening else -1 if c == closing else 0
        if depth == 0:
            size = end - at + 1
            if not (marked and size > LONG_WITH_MARK or size > LONG):
                return None
            last = end
            while last < min(end + 2, len(text) - 1) and text[last + 1] in ABSORBED:
                last += 1
            return text[at : last + 1], last
        marked = marked or c in INNER
    return None


_WIDE = str.maketrans("()", "（）")
# Kinds of marks by their opening and by their closing one, which several may share; a mark that closes itself never closes.
_OPENS = {a: k for k, (a, b) in enumerate(zip(OPENING, CLOSING, strict=True)) if a != b}
_CLOSES = {b: [k for a, k in _OPENS.items() if CLOSING[k] == b] for b in CLOSING}
_ANY_OPENING = re.compile(f"[{re.escape(''.join(_OPENS))}(]")
_ANY_MARK = re.compile(f"[{re.escape(''.join(dict.fromkeys([*_OPENS, *(b for b in _CLOSES if _CLOSES[b])])))}]")
_ANY_INNER = re.compile(f"[{re.escape(INNER)}]")


def quote_spans(line: str | None) -> list[str]:
    """All quotations of a line, none within another: those of ``quote_span``, with all marks paired in one pass."""
    if not line or not _ANY_OPENING.search(line):
        return []
    text = line.translate(_WIDE) if "(" in line or ")" in line else line
    pending: list[list[int]] = [[] for _ in OPENING]
    pairs: list[tuple[int, int]] = []
    for found in _ANY_MARK.finditer(text):
        c, at = found[0], found.start()
        if c in _OPENS:
            pending[_OPENS[c]].append(at)
        else:
            pairs += [(pending[k].pop(), at) for k in _CLOSES[c] if pending[k]]
    out, free, most = [], 0, len(text) - 1
    for at, end in sorted(pairs):
        size = end - at + 1
        if at < free or size <= LONG_WITH_MARK or size <= LONG and not _ANY_INNER.search(text, at, end):
            continue
        last = end
        while last < min(end + 2, most) and text[last + 1] in ABSORBED:
            last += 1
        out.append(text[at : last + 1])
        free = last + 1
    return out
