"""``python -m corpusloom crawl|parse|filter|separate INPUT OUTPUT``: the jobs over tables.

``--config FILE`` gives settings as JSON: the fields of CrawlConfig (with ``seeds``, a list of urls), ParseConfig, FilterConfig
or SeparateConfig.  A crawl without seeds starts from every page.  ``--metrics FOLDER`` appends the number of rows.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import CrawlConfig, FilterConfig, ParseConfig, SeparateConfig
from corpusloom.operators import crawl, documents, extract, lines
from corpusloom.sources import texts


def run_crawl(spark: SparkSession, source: str, seeds: list[str] | None = None, **settings) -> DataFrame:
    how = CrawlConfig(**settings)
    pages = spark.read.parquet(source)
    start = pages.select("url") if seeds is None else spark.createDataFrame([(x,) for x in seeds], "url string")
    any_of = lambda patterns: "|".join(f"(?:{p})" for p in patterns) or None
    return crawl.crawl_pages(
        start.filter("url is not null"), pages, any_of(how.accept), any_of(how.reject),
        replacements=[tuple(x) for x in how.replacements], window=how.window and tuple(how.window), pattern=how.date_pattern, max_body=how.max_body,
    )


def run_parse(spark: SparkSession, source: str, strategy: str = extract.MIXED, extraction: dict | None = None, window: tuple[str, str] | None = None) -> DataFrame:
    how = ParseConfig(extract.Extraction(**(extraction or {"accept": ["article"], "mode": "br2n"})), strategy, window and tuple(window))
    pages = spark.read.parquet(source)
    if how.window:
        pages = crawl.dated(pages, *how.window).filter("in_window")
    return extract.parsed(pages, how.extraction, how.strategy)


def run_filter(spark: SparkSession, source: str, **settings) -> DataFrame:
    how = FilterConfig(**settings)
    return lines.filtered(lines.to_lines(spark.read.parquet(source)), least_length=how.least_length, max_run=how.max_run, least=how.least_han, share=how.least_share)


def run_separate(spark: SparkSession, source: str, **settings) -> DataFrame:
    how = SeparateConfig(**settings)
    docs = documents.gated(spark.read.parquet(source), how.least_chars)
    return documents.packed_by_window(docs.filter("verdict = 'keep'"), "n_chars", ["doc_id"], how.part_chars)


JOBS = {"crawl": run_crawl, "parse": run_parse, "filter": run_filter, "separate": run_separate}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--config")
    parser.add_argument("--metrics")
    given = parser.parse_args(arguments)
    settings = json.loads(Path(given.config).read_text()) if given.config else {}
    spark = SparkSession.builder.getOrCreate()
    counted = Observation()
    out = JOBS[given.job](spark, given.source, **settings).observe(counted, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(given.target)
    if given.metrics:
        texts.write_metrics(spark, given.job, counted.get, given.metrics)


if __name__ == "__main__":
    main()
