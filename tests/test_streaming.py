"""Streams: restart, removal of repeats over micro-batches, changed rules."""

import time

from pyspark.sql import functions as F

from corpusloom.streaming import flows


def _pages(spark, path, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(path)


def test_urls_once_over_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        found = flows.new_urls(flows.read_pages(spark, source, files=1))
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.url for r in spark.read.schema("url string").parquet(out).collect())

    _pages(spark, source, [(1, "http://h/", '<a href="/a"><a href="/b">')])
    assert run() == ["http://h/a", "http://h/b"]
    _pages(spark, source, [(2, "http://h/", '<a href="/b"><a href="/c">')])
    assert run() == ["http://h/a", "http://h/b", "http://h/c"]


def test_rules_are_asked_every_tick(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rules = {"reject": "/b$"}
    write = flows.archive_writer(out, 1, lambda: (None, rules["reject"]))
    for n in (1, 2):
        _pages(spark, source, [(n, "http://h/a", ""), (n, "http://h/b", "")])
        flows.run_ticks(flows.read_pages(spark, source), write, state).awaitTermination()
        rules["reject"] = "/a$"
    rows = spark.read.parquet(out)
    assert sorted((r.page_id, r.url) for r in rows.collect()) == [(1, "http://h/a"), (2, "http://h/b")]


def test_clean_lines_and_rates(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "的一是不了在a\n的一是不了在b\nx")], "doc_id long, text string").write.parquet(source)
    stream = spark.readStream.schema("doc_id long, text string").parquet(source)
    flows.clean_lines(stream).writeStream.format("memory").queryName("cleaned").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("cleaned").count() == 1
    spark.createDataFrame([(x,) for x in ("2024-01-01 00:00:01", "2024-01-01 00:00:02", "2024-01-01 00:00:11")], "ts string").select(F.col("ts").cast("timestamp").alias("ts")).write.parquet(str(tmp_path / "e"))
    events = spark.readStream.schema("ts timestamp").parquet(str(tmp_path / "e"))
    flows.rates(events).writeStream.format("memory").queryName("rates").outputMode("complete").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.n, r.per_minute) for r in spark.table("rates").collect()) == [(1, 6), (2, 12)]


def test_ticks_are_told(spark, tmp_path):
    source, told = str(tmp_path / "in"), []
    spark.createDataFrame([(1, "的一是不了在a")], "doc_id long, text string").write.parquet(source)
    listener = flows.Ticks(told.append)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("doc_id long, text string").parquet(source)
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if any(x["rows"] == 1 for x in told):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert any(x["rows"] == 1 for x in told)
