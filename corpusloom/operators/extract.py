"""Main text of pages: by selectors, by shallow features of text blocks, or by both."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import dom

#: Names of the strategies.
SELECTORS, BOILERPLATE, MIXED = "jparser", "bparser", "mixparser"


@dataclass(frozen=True)
class Extraction:
    """Selectors of elements to take and to leave out, how text is written, what marks a missing page, where categories stand, and whether only closed references are read."""

    accept: list[str] = field(default_factory=list)
    reject: list[str] = field(default_factory=list)
    mode: str = "visitor"
    missing: str | None = None
    categories: str | None = None
    closed: bool = False

    def __post_init__(self) -> None:
        for text in (*self.accept, *self.reject, *filter(None, (self.missing, self.categories))):
            dom.selector(text)

    def apply(self, root: dom.Element) -> tuple[str | None, list[str]]:
        if self.missing and dom.select(root, self.missing):
            return None, []
        named = dom.categories(root, self.categories) if self.categories else []
        return dom.selected_text(root, self.accept, self.reject, self.mode), named


BLOCK = "struct<block:string,words:long,link_words:long>"


def _blocks(root: dom.Element) -> list[dict]:
    return [{"block": text, "words": words, "link_words": linked} for text, words, linked in dom.blocks(root)]


def page_blocks(pages: DataFrame, key: str = "page_id", closed: bool = False) -> DataFrame:
    """(key, blocks) of every page: its runs of text between block elements, with their words and words in links."""
    return _read(pages, key, lambda html: (None, [], _blocks(dom.parse(html, closed)))).select(key, "blocks")


def content_text(blocks: Column) -> Column:
    """The content blocks of ``blocks``, joined by line ends: the published decision tree over words and link density of a block and its neighbours.

    Neighbours are looked up in the array: nothing is shuffled for a page.
    """
    density = lambda x: F.coalesce(x["link_words"] / F.greatest(x["words"], F.lit(1)), F.lit(0.0))
    words = lambda x: F.coalesce(x["words"], F.lit(0))

    def content(x: Column, i: Column) -> Column:
        before, after = F.get(blocks, i - 1), F.get(blocks, i + 1)
        after_links = (words(x) > 17) | ((density(after) <= 1 / 3) & (words(after) > 17))
        after_text = (words(x) > 16) | (words(after) > 15) | (words(before) > 4)
        return F.when(density(x) > 1 / 3, False).when(density(before) > 5 / 9, after_links).otherwise(after_text)

    return F.array_join(F.transform(F.filter(blocks, content), lambda x: x["block"]), "\n")


def main_text(pages: DataFrame, key: str = "page_id", closed: bool = False) -> DataFrame:
    """(key, text): content blocks of each page, joined by line ends; empty if there are none."""
    return page_blocks(pages, key, closed).select(key, content_text(F.col("blocks")).alias("text"))


def _read(pages: DataFrame, key: str, made: Callable[[str | None], tuple]) -> DataFrame:
    """(key, text, categories, blocks) as ``made`` gives them for each page's html."""
    rows = pages.select(key, "html")
    kinds = pa.list_(pa.struct([("block", pa.string()), ("words", pa.int64()), ("link_words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [made(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.list_(pa.string())), pa.array([x[2] for x in out], kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "text", "categories", "blocks"])

    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, text string, categories array<string>, blocks array<{BLOCK}>")


def selected(pages: DataFrame, how: Extraction, key: str = "page_id") -> DataFrame:
    """(key, text, categories) by selectors; a null text says that no selector matched."""
    return _read(pages, key, lambda html: (*how.apply(dom.parse(html, how.closed)), None)).select(key, "text", "categories")


def parsed(pages: DataFrame, how: Extraction, strategy: str | Callable[[str | None], str | None] = SELECTORS, key: str = "page_id") -> DataFrame:
    """(key, text, categories) by a strategy, in one pass over the pages.

    The mixed one judges blocks only of pages for which the selectors give null
    (not: empty).  A function from html to text is a strategy of one's own.
    """
    none = F.array().cast("array<string>")
    if callable(strategy):
        own = strategy
        return _read(pages, key, lambda html: (own(html), [], None)).select(key, "text", "categories")
    if strategy == BOILERPLATE:
        return main_text(pages, key, how.closed).withColumn("categories", none)
    if strategy not in (SELECTORS, MIXED):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == SELECTORS:
        return selected(pages, how, key)

    def mixed(html: str | None) -> tuple:
        whole = dom.parse(html, how.closed)
        # Leaving out elements changes the tree, of which the blocks are the whole.
        blocks = _blocks(whole)
        text, named = how.apply(whole)
        return (text, named, None) if text is not None else (None, [], blocks)

    rows = _read(pages, key, mixed)
    return rows.select(key, F.coalesce("text", content_text(F.col("blocks"))).alias("text"), "categories")
