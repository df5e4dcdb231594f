"""Operators 11 to 13 against brute force and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tickertide.llm import chat, lines, queries, sharding, trie, variants

SF = "/root/testdata/sf0.001"


# shards


def dealt(spark, rows, schema="doc_id long, text string, bucket long, shard string", **params):
    out = sharding.shards(spark.createDataFrame([(*r, 7, "x") for r in rows], schema), **params)
    assert out.columns == ["doc_id", "text", "bucket", "shard", "slot"]
    return [(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in out.collect()]


@pytest.mark.parametrize("n,params", [(0, {}), (1, {}), (15, {}), (100, {"n_shards": 7}), (3000, {"bucket_bytes": 5000}), (3000, {"n_shards": 1, "bucket_bytes": 5000})])
def test_shards_keep_all_rows_in_shards_of_like_size(spark, n, params):
    rng = random.Random(n)
    # a third of the rows share an id and a text
    rows = [(5, "same") if rng.random() < 0.3 else (rng.choice([None, i]), rng.choice([None, "", "é" * rng.randint(1, 40), f"t{i}"])) for i in range(n)]
    got = dealt(spark, rows, **params)
    assert Counter(r[:2] for r in got) == Counter(rows)
    shards = defaultdict(list)
    for *_, shard, slot in got:
        shards[shard].append(slot)
    k = params.get("n_shards", sharding.SHARDS)
    sizes = [len(shards.get(s, ())) for s in range(k)]
    assert set(shards) <= set(range(k)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_shards_are_in_random_order(spark):
    rows = [(i, "some text") for i in range(4000)]
    place = {}
    for seed in (1, 2):
        got = sorted(dealt(spark, rows, bucket_bytes=20_000, seed=seed), key=lambda r: (r[2], r[3]))
        place[seed] = {r[0]: k for k, r in enumerate(got)}
        assert place[seed] == {r[0]: k for k, r in enumerate(sorted(dealt(spark, rows, bucket_bytes=20_000, seed=seed), key=lambda r: (r[2], r[3])))}
        # neighbours of the table part, and each sixteenth of it goes everywhere
        assert sum(abs(place[seed][i] - place[seed][i + 1]) < 40 for i in range(3999)) < 200
        spread = Counter((i // 250, place[seed][i] // 250) for i in range(4000))
        assert len(spread) == 256 and max(spread.values()) < 50
    assert sum(place[1][i] == place[2][i] for i in range(4000)) < 20


def test_buckets_are_bounded_by_bytes(spark):
    """Records that share an id scatter too, so no bucket holds much more than its share."""
    frame = spark.createDataFrame([(1, "x" * 100) for _ in range(6000)], "doc_id long, text string")
    sizes = [r["count"] for r in sharding.scattered(frame, 20).groupBy("bucket").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 400 and sum(sizes) == 6000


def test_written_shards_are_in_order(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id long, text string")
    sharding.write(sharding.shards(frame, 4), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 500 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
    for path in back.inputFiles():
        slots = [r["slot"] for r in spark.read.parquet(path).collect()]
        assert slots == sorted(slots)


def test_op12_columns(spark):
    got = {r["doc_id"]: r for r in queries.op12_shards(spark, SF).collect()}
    want = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {i: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for i, r in got.items()} == {i: (len(t) + 1, zlib.crc32(t), "rows", None) for i, t in want.items()}


# trie


def plain_trie(rows, rebuild=True):
    """rows (conv_id, turn, role, text), turns of a conversation all different"""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    if rebuild:
        head = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - c % 5, [])[: head[c]] + v[head[c] :] for c, v in convs.items()}
    members, kids = defaultdict(list), defaultdict(set)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
            if d:
                kids[tuple(said[: d - 1])].add(tuple(said[:d]))
    total = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, own + sum(total[k][1] for k in kids[p]))
    ends = lambda p: ",".join(str(c) for c in sorted(m for m in members[p] if len(convs[m]) == len(p)))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *total[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items())


def found_trie(spark, rows, rebuild=True):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn int, role string, text string, c long, depth string, k string")
    return sorted(tuple(r) for r in trie.prefix_trie(frame, rebuild=rebuild).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def key(r):
    return r[:2]


def test_trie_equals_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for c in [*range(0, 60), 101, 103, 10**12 + 1]:
        turns = list(range(rng.choice([1, 2, 4, 12]))) + ([None] if rng.random() < 0.2 else [])
        rows += [(c, t, rng.choice(["user", "user", None]), rng.choice(["a", "a", "bé", "", None])) for t in turns]
    rows += [(None, 1, "user", "lost")]
    for rebuild in (True, False):
        assert sorted(found_trie(spark, rows, rebuild), key=key) == sorted(plain_trie(rows, rebuild), key=key)


def test_trie_of_chains_and_stars(spark):
    """A long conversation, one that leaves it late, many that share a first turn only, and a third that are all alike."""
    rows = [(1, t, "u", f"x{t}") for t in range(150)] + [(2, t, "u", f"x{t}" if t < 100 else f"y{t}") for t in range(130)]
    rows += [(c, t, "u", "hello" if t == 0 else f"{c}") for c in range(10, 110) for t in range(3)]
    rows += [(c, t, "u", f"same {t}") for c in range(200, 280) for t in range(4)]
    assert sorted(found_trie(spark, rows, False), key=key) == sorted(plain_trie(rows, False), key=key)


def test_trie_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(7, 0, "u", "a")]) == plain_trie([(7, 0, "u", "a")])  # its first turns are not its own: turnless
    rows = [(c, 0, "u", "a") for c in range(1000, 1100)]
    assert sorted(found_trie(spark, rows), key=key) == sorted(plain_trie(rows), key=key)
    again = [(3, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "b")]  # repeated rows stay, as turns of their own
    assert [r[1] for r in sorted(found_trie(spark, again, False), key=key)] == [0, 1, 2, 3]


def test_totals_of_random_trees(spark):
    rng = random.Random(3)
    parent = {}
    for v in range(1, 400):
        parent[v] = rng.choice([v - 1, v - 1, v - 1, rng.randrange(v)])
    depth = {0: 0}
    for v in range(1, 400):
        depth[v] = depth[parent[v]] + 1
    kids = defaultdict(list)
    for v, p in parent.items():
        kids[p].append(v)
    xor = lambda vs: __import__("functools").reduce(lambda a, b: a ^ b, vs, 0)
    rows = [(v, depth[v], parent.get(v), depth[parent[v]] if v else None, len(kids[v]), xor(kids[v]), xor(depth[k] for k in kids[v]), v * v) for v in range(400)]
    frame = spark.createDataFrame(rows, "conv_id long, depth long, p_conv long, p_depth long, k long, x_conv long, x_depth long, value long")
    total = {}
    for v in range(399, -1, -1):
        total[v] = v * v + sum(total[k] for k in kids[v])
    assert {r["conv_id"]: r["value"] for r in trie.subtree_totals(frame, ["value"]).collect()} == total


def test_op13_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(queries.ORACLE_SQL["op13_prefix_trie"])
    names = [d[0] for d in want.description]
    got = queries.op13_prefix_trie(spark, SF).select(*names)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)
    assert all(kind == "bigint" for name, kind in got.dtypes if name != "ends_sha256")


# spelling variants

LOWER = {ord(a): ord(a) + 32 for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, chars=5, least=3, ratio=2, noise=97):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= chars and c >= least}
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    form = {a: b for a in n if near[a] and n[b := min(near[a], key=lambda x: (-n[x], x))] >= ratio * n[a]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items()}


def found_variants(spark, rows, **params):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, word string, n long, key string")
    return {tuple(r) for r in variants.variants(frame, **params).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdéÿ") for _ in range(rng.randint(5, 8))) for _ in range(25)]

    def spelled(w):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdé") + w[i:], w[:i] + rng.choice("abcdÉ") + w[i + 1 :]])
        return w.upper() if rng.random() < 0.1 else w

    rows = [(rng.choice([i, None]), rng.choice([" ", ", ", "\n", "1", "_"]).join(spelled(rng.choice(base)) for _ in range(60))) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "ab abcd"), (4, "Àé×÷ÿ " * 3), (4, "Àé×÷ÿ " * 3)]
    for params in ({}, {"noise": 7}, {"min_chars": 1, "min_count": 1}):
        want = plain_variants(rows, params.get("min_chars", 5), params.get("min_count", 3), noise=params.get("noise", 97))
        assert found_variants(spark, rows, **params) == want and len(want) > 50


def test_near_words_share_a_signature():
    rng, made = random.Random(3), variants.Signatures()
    for _ in range(3000):
        w = "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 14)))
        i = rng.randrange(len(w))
        other = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcz") + w[i:], w[:i] + rng.choice("abcz") + w[i + 1 :]])
        if other in ("", w):
            continue
        a, b = sorted((w, other), key=len)
        assert set(made.keys(a)[0]) & set(made.keys(b)[len(b) - len(a)])


def test_words_of_like_letters_part(spark):
    """Thousands of anagrams have all signatures in common; they meet only where they share a half."""
    rng = random.Random(4)
    words = sorted({"".join(rng.sample("abcdefghijkl", 12)) for _ in range(3000)})
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    assert variants.near_pairs(frame).count() == 0
    met = variants.signatures(frame).select(F.explode("own").alias("key")).groupBy("key").count().agg(F.max("count")).first()[0]
    assert met < 20


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i:02d}", f"w{i + 1:02d}") for i in range(40)], "word string, form string")
    assert {r["root"] for r in variants.roots(forms).collect()} == {"w40"}
    assert variants.roots(forms.limit(0)).count() == 0
    assert found_variants(spark, []) == set()


def test_long_texts(spark):
    long = "alphas betas " * 100_000 + "alphaz " * 3
    assert {w[:5] for w in found_variants(spark, [(1, long)], noise=0)} == {("alphas", None, "alphas", 100_000, 1), ("betas", None, "betas", 100_000, 0), ("alphaz", "alphas", "alphas", 3, 1)}


# chats


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_chat_ids_keep_their_type(spark, kind):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"what is {t}?" if t % 2 == 0 else "It is so.") for c in range(3) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv_id", F.col("conv_id").cast(kind))
    out = chat.format_chats(frame)
    assert dict(out.dtypes)["conv_id"] == kind and {str(r["conv_id"]) for r in out.collect()} == {"0", "1", "2"}


# lines


def test_lines_of_one_opening_do_not_meet(spark):
    """Thousands of lines share their first four words, and so a block, and nothing else; among them are near copies."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    own = ["one and the same " + " ".join(rng.sample(words, 16)) for _ in range(3000)]
    copies = [" ".join(w if k != 9 else "changed" for k, w in enumerate(t.split())) for t in own[:40]]
    frame = spark.createDataFrame(list(enumerate(own + copies)), "doc_id long, text string")
    gone = {r["id"]: list(r["nos"]) for r in lines.drops(frame).collect()}
    assert gone == {3000 + i: [0] for i in range(40)}


def test_groups_of_near_lines_meet_whoever_leads(spark):
    """A group of lines each a few words from a common one, so that many pairs of it are not alike, stays one group."""
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(30)]
    made = []
    for _ in range(300):
        line = list(base)
        for i in rng.sample(range(30), 4):
            line[i] = "".join(rng.choice("abcdefghij") for _ in range(5))
        made.append(" ".join(line))
    frame = spark.createDataFrame(list(enumerate([" ".join(base), *made])), "doc_id long, text string")
    # 4 of 30 words from the common line, which is within the similarity; two of them may differ by 8. Blocks may miss some
    gone = {r["id"] for r in lines.drops(frame).collect()}
    assert gone <= set(range(1, 301)) and len(gone) >= 285


def test_lines_with_much_of_their_own_do_not_meet(spark, monkeypatch):
    """Lines that share a passage and have more words of their own than edits can spoil do not go to the check of edits."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    half, rest = (["z" + word() for _ in range(15)] for _ in range(2))  # their words lead
    own = [" ".join([*(word() for _ in range(6)), *half, *(word() for _ in range(6)), *rest, *(word() for _ in range(6))]) for _ in range(150)]
    copies = [" ".join(w if k != 20 else "changed" for k, w in enumerate(t.split())) for t in own[:10]]
    frame = spark.createDataFrame(list(enumerate(own + copies)), "doc_id long, text string")
    seen, real = [], lines._verified

    def counted(pairs, texts, similarity):
        seen.append(pairs.count())
        return real(pairs, texts, similarity)

    monkeypatch.setattr(lines, "_verified", counted)
    gone = {r["id"]: list(r["nos"]) for r in lines.drops(frame).collect()}
    assert gone == {150 + i: [0] for i in range(10)} and seen[-1] < 500


def passage_lines(n, own):
    """n lines of 30 words, all but the last own of them the same, and copies of the first ten with one word changed."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = ["z" + word() for _ in range(30 - own)]  # its words lead
    texts = [[*passage, *(word() for _ in range(own))] for _ in range(n)]
    return [" ".join(t) for t in texts] + [" ".join(w if k != 20 else "changed" for k, w in enumerate(t)) for t in texts[:10]]


def test_lines_just_short_of_the_similarity_are_told_where_they_meet(spark, monkeypatch):
    """Lines that share 23 of 30 words, with no more pairs of words of their own than edits can spoil, lead to no pairs that move on."""
    frame = spark.createDataFrame(list(enumerate(passage_lines(150, 7))), "doc_id long, text string")
    seen, real = [], lines._verified

    def counted(pairs, texts, similarity):
        seen.append(pairs.count())
        return real(pairs, texts, similarity)

    monkeypatch.setattr(lines, "_verified", counted)
    gone = {r["id"]: list(r["nos"]) for r in lines.drops(frame).collect()}
    assert gone == {150 + i: [0] for i in range(10)} and seen[-1] < 500


def test_lines_meet_in_turns(spark, monkeypatch):
    frame = spark.createDataFrame(list(enumerate(passage_lines(100, 7))), "doc_id long, text string")
    monkeypatch.setattr(lines, "TURN", 900)
    asked, real = [], lines._turns
    monkeypatch.setattr(lines, "_turns", lambda rows: asked.append(real(rows)) or asked[-1])
    assert {r["id"] for r in lines.drops(frame).collect()} == set(range(100, 110)) and min(asked) > 1


@pytest.mark.parametrize("similarity", [0.8, 0.9, 0.7])
def test_near_lines_lack_few_grams_of_each_other(spark, similarity):
    """Lines at the similarity, with words put in, taken out and changed, against the number of grams that _most_own allows."""
    rng, rows = random.Random(3), []
    for _ in range(600):
        a = [f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 60))]
        b, most = list(a), rng.random() * 0.3 * len(a)
        kind = rng.choice(["in", "out", "all"])
        for _ in range(int(most)):
            k = rng.randrange(len(b))
            b[k : k + (kind != "in" and rng.random() < 0.9)] = ["new"] * (kind == "in" or (kind == "all" and rng.random() < 0.6))
        if len(b) >= 5:
            rows.append((a, b))
    frame = spark.createDataFrame(rows, "a array<string>, b array<string>")
    coded = {c: lines.coded(F.col(c)) for c in "ab"}
    near = frame.where(lines.alike(F.array_join("a", " "), F.array_join("b", " "), coded["a"], coded["b"], similarity))
    own = lambda x, y: F.size(F.array_except(lines._grams(F.col(x), similarity), lines._grams(F.col(y), similarity))) <= lines._most_own(F.size(x), similarity)
    assert near.count() > 100 and near.where(~(own("a", "b") & own("b", "a"))).count() == 0
