"""The operators on streams: cleaning, removal of repeats, batches of a bounded size, crawling in ticks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from corpusloom.functions import urls
from corpusloom.operators.crawl import page_links
from corpusloom.operators.lines import judged, to_lines


def read_pages(spark: SparkSession, path: str, schema: str = "page_id long, url string, html string", files: int = 100) -> DataFrame:
    """A stream of Parquet pages, so many files a tick."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def new_urls(pages: DataFrame, accept: str | None = None, reject: str | None = None) -> DataFrame:
    """Links of streamed pages, each once in the whole run.  The state holds all urls; see ``new_urls_within`` for a bounded one."""
    return page_links(pages, accept, reject).select(F.col("link").alias("url")).dropDuplicates(["url"])


def new_urls_within(links: DataFrame, ts: str, delay: str) -> DataFrame:
    """Each url once within the watermark: the state is bounded."""
    return links.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url"])


def clean_lines(docs: DataFrame, **limits) -> DataFrame:
    """Good lines of streamed documents, the first of equal Han content each."""
    return judged(to_lines(docs), **limits).filter("verdict = 'ok'").dropDuplicates(["han"])


def rates(visits: DataFrame, ts: str = "ts", seconds: int = 10, delay: str = "1 minute") -> DataFrame:
    """Visits in windows of event time, as a rate per minute."""
    counted = visits.withWatermark(ts, delay).groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "n", (F.col("n") * F.lit(60 // seconds)).alias("per_minute"))


def run_ticks(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, tick: str | None = None) -> StreamingQuery:
    """Gives every micro-batch to a function; without a tick it ends when all there is has been read.  Restarts from the checkpoint."""
    trigger = {"processingTime": tick} if tick else {"availableNow": True}
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def archive_writer(path: str, rows: int, rules: Callable[[], tuple[str | None, str | None]] = lambda: (None, None)) -> Callable[[DataFrame, int], None]:
    """For ``run_ticks``: accepted pages into files of at most ``rows``, by batch.  ``rules`` is asked anew every tick.

    A batch that is written again after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        accept, reject = rules()
        kept = batch.filter(urls.accepted(F.col("url"), accept, reject))
        kept.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(f"{path}/batch={number}")

    return write


class Ticks(StreamingQueryListener):
    """Gives the rows and the rows a second of every tick of all queries to a function, as a rolling log."""

    def __init__(self, sink: Callable[[dict], None]):
        self.sink = sink

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.sink({"query": str(p.id), "tick": p.batchId, "rows": p.numInputRows, "per_second": p.processedRowsPerSecond})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
