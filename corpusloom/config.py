"""Settings of a job, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, field

from corpusloom.functions import dates
from corpusloom.operators.extract import BOILERPLATE, MIXED, SELECTORS, Extraction

#: Least length of the url queue, pages of an archive batch, bytes of a page's body.
LEAST_QUEUE, BATCH_PAGES, MAX_BODY = 2000, 10_000, 1 << 20


@dataclass(frozen=True)
class CrawlConfig:
    """Rules of a crawl.  Lists of patterns are lists; an empty one means: no rule."""

    accept: list[str] = field(default_factory=list)
    reject: list[str] = field(default_factory=list)
    replacements: list[tuple[str, str]] = field(default_factory=list)
    window: tuple[str, str] | None = None
    date_pattern: str = dates.DATE_PATTERN
    max_body: int = MAX_BODY
    batch_pages: int = BATCH_PAGES
    queue: int = 200_000
    store_parsed: bool = False

    def __post_init__(self) -> None:
        if self.window:
            dates.check_window(*self.window)
        if self.queue < LEAST_QUEUE or self.batch_pages < 1 or self.max_body < 0:
            raise ValueError(f"a queue has {LEAST_QUEUE} places at least, a batch one page")


@dataclass(frozen=True)
class ParseConfig:
    """How main text is found; selectors are needed unless blocks alone decide."""

    extraction: Extraction = field(default_factory=Extraction)
    strategy: str = SELECTORS
    window: tuple[str, str] | None = None

    def __post_init__(self) -> None:
        if self.strategy not in (SELECTORS, BOILERPLATE, MIXED):
            raise ValueError(f"unknown strategy: {self.strategy}")
        if self.strategy != BOILERPLATE and not self.extraction.accept:
            raise ValueError("a selector is needed")
        if self.window:
            dates.check_window(*self.window)


@dataclass(frozen=True)
class FilterConfig:
    least_length: int = 5
    least_han: int = 5
    least_share: float = 0.7
    max_run: int | None = None


@dataclass(frozen=True)
class SeparateConfig:
    least_chars: int = 50
    part_chars: int = 30_000_000
    least_bytes: int = 0
