"""Kept scores, dated stores, calendar spans and the streams' ends."""

import datetime

import pytest
from pyspark.sql import functions as F

from tickertide.operators import records as P
from tickertide.operators import scores, tables
from tickertide.sources import io
from tickertide.streaming import stream


def test_texts_are_scored_once(spark, tmp_path):
    path, seen = f"{tmp_path}/scores", []

    def scorer(texts):
        seen.append(sorted(r["text"] for r in texts.collect()))
        return texts.withColumn("n", F.length("text"))

    def run(texts, batch, version="1"):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, body string")
        return sorted((r["id"], r["n"]) for r in scores.get_or_compute(frame, "body", scorer, path, version, batch).collect())

    assert run(["a", "bb", "a", None, ""], "b0") == [(0, 1), (1, 2), (2, 1), (3, 0), (4, 0)]
    assert run(["bb", "ccc"], "b1") == [(0, 2), (1, 3)]
    assert run(["bb", "ccc"], "b1") == [(0, 2), (1, 3)]  # the same batch again: it is as if it ran once
    assert run(["a", "ccc"], "b2") == [(0, 1), (1, 3)]
    assert run(["a"], "b0", version="2") == [(0, 1)]
    assert seen == [["", "a", "bb"], ["ccc"], ["ccc"], [], ["a"]]
    assert run([], "b3") == []


def test_dated_store_reads_its_dates_only(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(hours=7 * k)) for k in range(100)]
    frame = spark.createDataFrame(rows, "id long, ts timestamp")
    io.write_dated(frame, f"{tmp_path}/store", "ts", spread=2)
    found = io.read_dated(spark, f"{tmp_path}/store", "2024-01-05", "2024-01-07")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: []" in plan
    assert found.select("date").distinct().count() == 3
    assert {r["id"] for r in found.collect()} == {k for k, t in rows if datetime.datetime(2024, 1, 5) <= t < datetime.datetime(2024, 1, 8)}
    # an overwrite replaces the dates it has
    io.write_dated(frame.where("id < 3").withColumn("id", F.col("id") + 1000), f"{tmp_path}/store", "ts", mode="overwrite")
    first = io.read_dated(spark, f"{tmp_path}/store", end="2024-01-01")
    assert {r["id"] for r in first.collect()} == {1000, 1001, 1002} and io.read_dated(spark, f"{tmp_path}/store").count() == 99


@pytest.mark.parametrize("multiplier,unit,want", [(1, "week", "2024-02-26"), (2, "month", "2024-03-01"), (1, "quarter", "2024-01-01"), (1, "year", "2024-01-01"), (10, "year", "2020-01-01"), (1, "day", "2024-03-03"), (6, "hour", "2024-03-03 12:00:00"), (15, "minute", "2024-03-03 17:30:00")])
def test_spans_of_the_calendar(spark, multiplier, unit, want):
    at = F.lit("2024-03-03 17:44:59").cast("timestamp_ntz")  # a Sunday
    assert str(spark.range(1).select(tables.span_start(at, multiplier, unit).cast("string").alias("s")).first()["s"]) == (want if " " in want else f"{want} 00:00:00")


def test_one_document_of_a_wrong_type_fails_alone(spark):
    good = '{"article_id":"a","source_name":"s","title":"t","url":"u","published_at":"2024-01-01T00:00:00Z","collection_timestamp":"2024-01-01T00:00:00Z","symbols":["A"],"processed":true,"sentiment":{"score":1,"label":"mixed"}}'
    rows = [good, good.replace('"t"', "5"), good.replace('["A"]', "[1]"), good.replace("true", '"yes"'), good.replace('"score":1', '"score":"high"'), good.replace('"url":"u"', '"url":null'), good.replace('["A"]', "[]")]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, value string").select("id", F.parse_json("value").alias("payload"))
    got = {r["id"]: [e.split("'")[1] + e[e.rindex(":") :] for e in r["errors"]] for r in P.check_news_payloads(frame).collect()}
    assert got == {0: [], 1: ["title: type"], 2: ["symbols: type"], 3: ["processed: type"], 4: ["sentiment.score: type"], 5: ["url: required"], 6: []}


def test_streams_end_together(spark, tmp_path):
    """The first query to end ends the others; one writes to the console."""
    spark.createDataFrame([("a line",)], "value string").write.text(f"{tmp_path}/in")
    rows = spark.readStream.schema("value string").text(f"{tmp_path}/in")
    shown = io.write_console(rows)
    shown.processAllAvailable()
    assert sum(p.numInputRows for p in shown.recentProgress) == 1
    ended = stream.start(rows, lambda batch, i: batch.write.mode("append").text(f"{tmp_path}/out"), f"{tmp_path}/check")
    stream.await_any(spark, 60)
    assert not shown.isActive and not ended.isActive and spark.read.text(f"{tmp_path}/out").count() == 1
    spark.streams.resetTerminated()
