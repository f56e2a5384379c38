"""URLs and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that a file name made of a URL leaves out, and its greatest length.
NOT_IN_FILE_NAMES, FILE_NAME_LENGTH = r'[.:/?*|"<>\\]', 250
_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def alternation(values: list[str] | None) -> str | None:
    """One pattern of all values; none of no values, which means: no rule."""
    return "|".join(values) if values else None


def find(text: Column, pattern: str | None) -> Column:
    """Whether a pattern is found anywhere; null without a pattern."""
    return text.rlike(pattern) if pattern is not None else F.lit(None).cast("boolean")


def group(text: Column, pattern: str, n: int = 1) -> Column:
    """A group of the first match, or null if nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, n))


def accepted(url: Column, accept: str | None, reject: str | None) -> Column:
    """Not rejected, and accepted if there is a rule for it; rejection comes first; false for null."""
    keep = F.lit(True) if reject is None else ~url.rlike(reject)
    if accept is not None:
        keep &= url.rlike(accept)
    return F.coalesce(keep & url.isNotNull(), F.lit(False))


def rewrite(url: Column, replacements: list[tuple[str, str]]) -> Column:
    """All replacements in order, each on the result of those before."""
    for pattern, target in replacements:
        url = F.regexp_replace(url, pattern, target)
    return url


def replacement_pairs(sources: list[str], targets: list[str]) -> list[tuple[str, str]]:
    if len(sources) != len(targets):
        raise ValueError("as many targets as sources are needed")
    return list(zip(sources, targets, strict=True))


def file_name(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(url, r"^(.*?)https?://", "$1"), NOT_IN_FILE_NAMES, "")
    return F.substring(bare, 1, FILE_NAME_LENGTH)


def hrefs(html: Column) -> Column:
    """All ``href`` values of ``a`` tags in order, as they stand in the page."""
    raw = F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))
    return F.transform(raw, lambda x: F.replace(F.regexp_replace(x, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` parts."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    start = F.array().cast("array<string>")
    step = lambda held, x: F.when(x == "..", F.when(F.size(held) > 1, F.slice(held, 1, F.size(held) - 1)).otherwise(held)).when(x == ".", held).otherwise(F.concat(held, F.array(x)))
    out = F.array_join(F.aggregate(parts, start, step), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(out, F.when(last.isin(".", ".."), "/").otherwise(""))).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """An absolute URL of a link in a page; empty where the base has no scheme and the link none either."""
    href = F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    scheme, site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    bare = F.regexp_extract(base, "^([^#]*)", 1)
    own, rest = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "^(.*/)", 1))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(site == "", "")
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, _without_dots(own), rest))
        .when((href == "") | href.startswith("#"), F.concat(bare, href))
        .when(href.startswith("?"), F.concat(site, path, href))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, own)), rest))
    )


def links(url: Column, html: Column, accept: str | None = None, reject: str | None = None) -> Column:
    """Distinct absolute links of a page in order, without empty, rejected and not accepted ones."""
    every = F.transform(hrefs(html), lambda x: resolve(url, x))
    return F.array_distinct(F.filter(every, lambda x: (x != "") & accepted(x, accept, reject)))


def full_match_links(url: Column, html: Column, pattern: str) -> Column:
    """Distinct links that a pattern matches as a whole, with blanks written as ``%20``."""
    every = F.transform(hrefs(html), lambda x: F.replace(resolve(url, x), F.lit(" "), F.lit("%20")))
    return F.array_distinct(F.filter(every, lambda x: x.rlike(f"^(?:{pattern})$")))
