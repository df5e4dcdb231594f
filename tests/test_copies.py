"""Near copies against all pairs, and the shapes of corpora that bring many texts into one bucket."""

import random
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tickertide.operators import copies
from tickertide.operators.graph import components

SCHEMA = "doc_id long, text string, id string, whole string, key string"


def made(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], SCHEMA)


def groups_of(rows, n=copies.WORDS, similarity=copies.SIMILARITY):
    """All pairs held against each other."""
    sets = [(i, frozenset(copies.shingle_hashes(t, n).tolist())) for i, t in rows if i is not None]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if len(x & y) >= similarity * len(x | y) - 1e-9:
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, least[find(k)]) for k, (i, _) in enumerate(sets))


def found(spark, texts, **params):
    return sorted((r["id"], r["group_id"]) for r in copies.similar(made(spark, texts), "doc_id", F.col("text"), **params).collect())


def words_of(rng, n=500):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_copies_equal_all_pairs(spark):
    rng = random.Random(1)
    words = words_of(rng)
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 90)))) for i in range(60)]
    for i in range(60, 120):  # copies with a few words changed, so that some stand on either side of the limit
        text = rows[i % 20][1].split()
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows += [(200 + i, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(5, 60)))) for i in range(40)]
    assert found(spark, rows) == groups_of(rows)
    assert found(spark, rows, n=3, similarity=0.6, bands=40, rows=3) == groups_of(rows, 3, 0.6)


def test_copies_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "one"), (None, "one"), (6, "one two"), (7, "a b c d e"), (7, "a b c d e f"), (8, "x " * 5000), (9, "x " * 4000)]
    assert found(spark, rows) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 7), (7, 7), (8, 8), (9, 8)]
    assert found(spark, []) == []


def test_no_copies_are_lost_to_signatures(spark):
    """Of pairs at 0.8 exactly, 19 in 20 at least share a bucket."""
    rng, made_of, hits = random.Random(2), copies.Signatures(), 0
    for _ in range(400):
        both = [rng.getrandbits(64) for _ in range(80)]
        a, b = (copies.np.array(sorted(both + [rng.getrandbits(64) for _ in range(10)]), copies.np.uint64) for _ in range(2))
        hits += bool(set(made_of.buckets(a)) & set(made_of.buckets(b)))
    assert hits >= 380


@pytest.mark.parametrize("n", [3000])
def test_a_shared_passage_makes_no_pairs(spark, n):
    """Texts with a passage of 100 words in common and 60 of their own: no copies, and no text is held against all others."""
    rng = random.Random(3)
    words = words_of(rng, 3000)
    passage = " ".join(rng.choice(words) for _ in range(100))
    rows = [(i, passage + " " + " ".join(rng.choice(words) for _ in range(60))) for i in range(n)]
    df = made(spark, rows)
    signed = copies.signed(df, "doc_id", F.col("text")).cache()
    assert signed.select(F.explode("keys").alias("key")).groupBy("key").count().agg(F.max("count")).first()[0] > n / 50  # buckets are hot
    sets = signed.select(F.col("id"), "whole", "size")
    hashed = copies.hashed(df, "doc_id", F.col("text"), sets.select("id", "whole")).join(sets.select("whole", "size"), "whole")
    assert copies.rare_keys(hashed).groupBy("key").count().where("count > 1").count() == 0
    began = time.monotonic()
    assert copies.similar(df, "doc_id", F.col("text")).where("id <> group_id").count() == 0
    assert time.monotonic() - began < 120


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 600)] + [(7, 7), (3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 600)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
