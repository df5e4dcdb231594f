"""The forms of operators that are made for very many symbols, terms, values or batches, against plain versions."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickertide.operators import correlation, search, sentiment, signals
from tickertide.sources import io
from tickertide.streaming import stream


# correlations


@pytest.mark.parametrize("width,stripes,times", [(4, 3, 5), (256, 1, 1024), (7, 8, 1)])
def test_gram_equals_pairs(spark, width, stripes, times):
    rng = random.Random(7)
    rows = [(f"s{k:02d}", t * 3600, rng.gauss(0, 1)) for k in range(23) for t in range(40) if rng.random() < 0.6]
    rows += [("flat", t * 3600, 0.5) for t in range(40)] + [("alone", 10**6, 1.0), (None, 0, 1.0), ("s00", None, 1.0), ("odd", 0, None), ("odd", 3600, float("nan"))]
    frame = spark.createDataFrame(rows, "symbol string, at long, ret double").withColumn("bar_ts", F.timestamp_seconds("at"))
    got = {(r["symbol_a"], r["symbol_b"]): (r["n"], r["correlation"]) for r in correlation.gram_correlations(frame, width, stripes, times).collect()}
    by = defaultdict(dict)
    for s, t, v in rows:
        if s is not None and t is not None and v is not None and v == v:
            by[s][t] = v
    want = {}
    for a in by:
        for b in by:
            shared = sorted(set(by[a]) & set(by[b]))
            if a < b and shared:
                x, y = [by[a][t] for t in shared], [by[b][t] for t in shared]
                mx, my = sum(x) / len(x), sum(y) / len(y)
                vx, vy = sum((v - mx) ** 2 for v in x), sum((v - my) ** 2 for v in y)
                want[a, b] = len(x), sum((p - mx) * (q - my) for p, q in zip(x, y)) / math.sqrt(vx * vy) if vx > 1e-12 and vy > 1e-12 else None
    assert got.keys() == want.keys()
    for pair, (n, c) in want.items():
        assert got[pair][0] == n and (got[pair][1] is None if c is None else got[pair][1] == pytest.approx(c, abs=1e-9)), pair
    assert correlation.gram_correlations(frame.limit(0)).count() == 0


# search


@pytest.fixture(scope="module")
def articles(spark):
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(20000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(f"u{i:04d}", say(5).upper(), say(15) if i % 7 else None, say(60)) for i in range(400)]
    return rows, spark.createDataFrame(rows, "url string, title string, description string, content string")


def test_index_finds_the_best(spark, articles, tmp_path):
    rows, frame = articles
    search.write_index(frame, f"{tmp_path}/index", buckets=8)
    weights = {r[0]: Counter() for r in rows}
    for url, *fields in rows:
        for field, w in zip(fields, (10, 5, 1), strict=True):
            for word in (field or "").lower().split():
                weights[url][word] += w
    for terms in (["w1"], ["w1", "w2"], ["W3", "w17", "none"], ["w2", "w5", "w9", "w40"], ["none"], []):
        for k in (1, 10, 1000):
            score = {u: sum(c[t.lower()] for t in terms) for u, c in weights.items()}
            want = sorted(((u, s) for u, s in score.items() if s), key=lambda x: (-x[1], x[0]))[:k]
            assert [(r["id"], r["relevance"]) for r in search.search_index(spark, f"{tmp_path}/index", terms, k, buckets=8).collect()] == want


def test_a_search_reads_its_terms_only(spark, articles, tmp_path):
    search.write_index(articles[1], f"{tmp_path}/index", buckets=8)
    found = search.index_terms(spark, f"{tmp_path}/index", ["w1"], buckets=8)
    plan = found.where("weight >= 20")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(term,w1)" in plan.replace(" ", "") and "GreaterThanOrEqual(weight,20)" in plan.replace(" ", "")
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) <= 8 and found.select("bucket").distinct().count() == 1


# sketches


def test_sketched_drift_is_near_the_exact_one(spark):
    rng = random.Random(9)
    a = spark.createDataFrame([(i * 600, rng.gauss(0, 1)) for i in range(20000)] + [(0, None)], "at long, x double").withColumn("ts", F.timestamp_seconds("at"))
    b = a.withColumn("x", F.col("x") * 1.3 + 0.2)
    exact = signals.drift(a.where("x is not null"), b.where("x is not null"), "x").first()["psi"]
    daily = [signals.daily_sketches(df, "x", "ts") for df in (a, b)]
    assert daily[0].count() == 139
    assert signals.sketched_drift(*daily).first()["psi"] == pytest.approx(exact, abs=0.01)
    assert signals.sketched_drift(daily[0], daily[0]).first()["psi"] == 0
    assert signals.sketched_drift(daily[0].limit(0), daily[1]).first()["psi"] is None
    # a sketch stays small, however many values it has seen
    sizes = [signals.merged(daily[0].limit(n)).select(F.length("sketch").alias("n")).first()["n"] for n in (10, 139)]
    assert sizes[1] < 100_000


def test_postings_make_rows_of_plain_words(spark):
    """Words become rows as they are, without a step in each text for each of them; empty and null fields have none, repeats add up."""
    frame = spark.createDataFrame([("u", "A b", None, "b"), ("v", "", " ,", "..b a"), ("u", None, "B", ""), ("w", None, None, None)], "url string, title string, description string, content string")
    found = search.postings(frame)
    assert "lambda" not in found._jdf.queryExecution().analyzed().toString()
    assert {(r["term"], r["id"]): r["weight"] for r in found.collect()} == {("a", "u"): 10, ("b", "u"): 16, ("b", "v"): 1, ("a", "v"): 1}


# lexicons


def test_rows_are_scored_each_by_itself(spark):
    rows = [(1, "good"), (1, "bad bad"), (None, "good"), (None, None), (2, ""), (2, "not very good")]
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -1.0), ("bad", -3.0), (None, 5.0), ("none", None)], "term string, valence double")
    got = sentiment.lexicon_sentiment(spark.createDataFrame(rows, "id long, text string"), lexicon, negations=["not"], boosters=["very"]).collect()
    one = lambda v: v / math.sqrt(v * v + 15)
    assert sorted((r["id"] or 0, round(r["compound"], 9)) for r in got) == sorted((i or 0, round(c, 9)) for i, c in [(1, one(2)), (1, one(-2)), (None, one(2)), (None, 0.0), (2, 0.0), (2, one(2.293 * -0.74))])


def test_many_terms_cost_little_more(spark):
    rng = random.Random(10)
    terms = sorted({"".join(rng.choice("abcdefgh") for _ in range(5)): rng.uniform(-3, 3) for _ in range(9000)}.items())
    texts = [" ".join(rng.choice(terms)[0] if rng.random() < 0.3 else "zzz" for _ in range(20)) for _ in range(50)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    began = time.monotonic()
    got = {r["id"]: r["s"] for r in frame.select("id", sentiment.lexicon_scores(F.col("text"), terms)["compound"].alias("s")).collect()}
    assert time.monotonic() - began < 30  # as literals for each term these took ten seconds and more to plan
    values = dict(terms)
    for i, t in enumerate(texts):
        s = sum(values.get(w, 0.0) for w in t.split())
        assert got[i] == pytest.approx(s / math.sqrt(s * s + 15))


# live counts


def test_live_stats_by_batch(spark, tmp_path):
    told = []
    stats = stream.LiveStats(tell=lambda batch, counts, totals: told.append((batch, counts["processed"], totals["processed"])))
    spark.streams.addListener(stats)
    try:
        for k, outcomes in enumerate((["valid"] * 3, ["invalid", "error"])):
            spark.createDataFrame([(o,) for o in outcomes], "outcome string").write.parquet(f"{tmp_path}/in/part={k}")
            rows = spark.readStream.schema("outcome string, part int").parquet(f"{tmp_path}/in").drop("part")
            stream.start(stream.live_counts(rows), lambda batch, i: batch.write.mode("append").parquet(f"{tmp_path}/out"), f"{tmp_path}/check").awaitTermination()
        for _ in range(100):  # listeners are told a little later
            if stats.totals["processed"] == 5:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(stats)
    assert stats.totals == {"processed": 5, "valid": 3, "invalid": 1, "error": 1}
    assert [t for t in told if t[1]] == [(0, 3, 3), (1, 2, 5)]


# dated stores


def test_dates_of_few_rows_are_one_file(spark, tmp_path):
    """Many dates are written by many tasks, most as one file; a date of many rows still goes to several; bounds at any distance find their rows."""
    frame = spark.range(24 * 120).selectExpr("id", "1704067200 + id * 3600 AS at").unionByName(spark.range(3000).selectExpr("id + 10000 AS id", "1704067200 + id AS at"))
    path = f"{tmp_path}/store"
    io.write_dated(frame, path, "at")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.read.parquet(path).inputFiles()
    assert len(files) <= 120 + tasks
    # rows of few bytes would all go to one task, which writes one folder after another
    assert len({f.rsplit("part-", 1)[1][:5] for f in files}) >= tasks - 1
    days = lambda start, end: io.read_dated(spark, path, start, end).count()
    assert days("2024-01-31", "2024-02-01") == 48 and days("2024-01-01", "2024-01-01") == 3024 and days("1901-01-01", "2100-01-01") == days(None, None) == 24 * 120 + 3000
    assert days("2031-01-01", "2031-02-01") == 0 and days("2024-02-01", "2024-01-01") == 0


def test_postings_make_rows_of_plain_words(spark):
    """Words become rows as they are, without a step in each text for each of them; empty and null fields have none, repeats add up."""
    frame = spark.createDataFrame([("u", "A b", None, "b"), ("v", "", " ,", "..b a"), ("u", None, "B", ""), ("w", None, None, None)], "url string, title string, description string, content string")
    found = search.postings(frame)
    assert "lambda" not in found._jdf.queryExecution().analyzed().toString()
    assert {(r["term"], r["id"]): r["weight"] for r in found.collect()} == {("a", "u"): 10, ("b", "u"): 16, ("b", "v"): 1, ("a", "v"): 1}


# lexicons


def test_a_lookup_compares_two_slots(spark):
    """Every term is found at its valence, no other word is; a lookup builds no array, however many terms there are."""
    for n in (1, 3, 70, 3000):
        terms = [(f"w{i}é", i % 7 - 3.0) for i in range(n)]
        words = spark.createDataFrame([(t,) for t, _ in terms] + [("w",), ("é",), ("",), (None,)], "word string")
        found = words.select("word", sentiment.Lexicon(terms).valence(F.col("word")).alias("v"))
        assert {r["word"]: r["v"] for r in found.collect()} == {**dict(terms), "w": None, "é": None, "": None, None: None}
        plan = found._jdf.queryExecution().analyzed().toString()
        assert "slice(" not in plan and "array_position(" not in plan and "lambda" not in plan
