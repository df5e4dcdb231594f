"""Models against their plain definitions, and the registered queries' columns and digests on the smallest tables."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import components_of, removed
from tickertide.llm import chat, neighbours, quality, queries, toxicity

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# models


def plain_buckets(word: str) -> list[int]:
    letters, out = f"<{word}>", []
    for n in toxicity.GRAMS:
        for i in range(len(letters) - n + 1):
            mixed = [(ord(ch) + 1) * 0x9E3779B97F4A7C15 & MASK for ch in letters[i : i + n]]
            h = mixed[0]
            for m in mixed[1:]:
                h = (h * 0x100000001B3 & MASK) ^ m
            out.append((h * 0xD6E8FEB86659FD93 & MASK) >> 46)
    return out


def test_toxicity_scores_as_defined():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS), -0.3)
    for text in ["", "one", "Some WORDS and some more, words!", "é🙂 日本語 a_b"]:
        words = toxicity.WORD.findall(text.lower())
        odds = model.bias + sum(np.mean([model.bucket[b] for b in plain_buckets(w)] or [0.0]) for w in words) / (len(words) + toxicity.PAD)
        assert toxicity.Scorer(model).score(text) == pytest.approx(1 / (1 + np.exp(-odds)))


def test_toxicity_shares_as_defined():
    words = toxicity.WORD.findall("the cat saw the other cat")
    want: dict[int, float] = {}
    for w in words:
        own = plain_buckets(w)
        for b in own:
            want[b] = want.get(b, 0) + 1 / len(own) / (len(words) + toxicity.PAD)
    assert dict(zip(*(x.tolist() for x in toxicity.features("the cat saw the other cat")))) == pytest.approx(want, rel=1e-5)


def test_forest_paths_as_defined():
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.normal(size=(300, 3)), [[9.0, 9, 9]]])
    forest = quality.Forest(rows, trees=20, size=64)

    def path(tree, row):
        f, at, left, right, length = tree
        node, depth = 0, 0
        while f[node] >= 0:
            node, depth = (left if row[f[node]] <= at[node] else right)[node], depth + 1
        assert length[node] >= depth and depth <= 6
        return length[node]

    want = [2 ** (-np.mean([path(t, r) for t in forest.trees]) / quality.Forest.usual(64)) for r in rows]
    assert forest.score(rows) == pytest.approx(want)
    assert np.argmax(want) == 300


def test_neighbours_at_the_registered_factor(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(40, 24)) * 3 + rng.normal(size=(1, 24)) for _ in range(50)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for r in neighbours.nearest(frame, F.col("id") % 40 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    d = np.sqrt(((x[::40, None] - x[None]) ** 2).sum(-1))
    d[np.arange(50), np.arange(0, 2000, 40)] = np.inf
    want = np.argsort(d, 1)[:, :10]
    assert np.mean([len(got[40 * i] & set(w.tolist())) / 10 for i, w in enumerate(want)]) >= 0.9


def test_roles_equal_one_viterbi_pass(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 3)
    frame = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = chat.turns(frame)
    start, move, emission = chat.learn(rows)
    got = {(r["id"], r["turn"]): r["found"] for r in chat.recover(rows, start, move, emission).collect()}
    seen = rows.select("id", "turn", "text", "seen").toPandas().sort_values(["id", "turn", "text"])
    for i, own in seen.groupby("id"):
        score, back = start + emission[:, own["seen"].iloc[0]], []
        for s in own["seen"].iloc[1:]:
            options = score[:, None] + move
            back.append(options.argmax(0))
            score = options.max(0) + emission[:, s]
        states = [int(score.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        assert [chat.ROLES[s] for s in reversed(states)] == [got[i, t] for t in own["turn"]]


# registered queries


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


def rows_of(spark, name, columns):
    out = queries.QUERIES[name](spark, SF)
    assert dict(out.dtypes) == dict(c.split() for c in columns.split(", "))
    return {r["doc_id"]: r for r in out.collect()}


def test_op1(spark, documents):
    got = rows_of(spark, "op1_toxicity", "doc_id bigint, held_out boolean, score double, predicted int")
    assert set(got) == set(documents.doc_id) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_op2(spark, documents):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(queries.tokenizer_path())
    got = rows_of(spark, "op2_bpe", "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    for i, t in zip(documents.doc_id, documents.text):
        ids = ref.encode(t or "", add_special_tokens=False).ids
        assert tuple(got[i])[1:] == (len(ids), sha(",".join(map(str, ids))), sha(ref.decode(ids, skip_special_tokens=False)))


def test_op3(spark, documents):
    got = rows_of(spark, "op3_quality", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean")
    for i, t in zip(documents.doc_id, documents.text):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert got[i]["n_words"] == len(w) and got[i]["word_chars"] == sum(map(len, w))
        assert got[i]["base_failed"] == (len(w) < 10 or 100 * got[i]["n_repeat_words"] > 20 * len(w)) and not (got[i]["kept"] and got[i]["base_failed"])


def test_op4(spark, documents):
    got = rows_of(spark, "op4_mix", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint")
    taken = pd.DataFrame([r.asDict() for r in got.values()]).merge(documents[["doc_id", "source"]], on="doc_id").groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (taken["taken"] - taken["target"]).abs().max() <= 1 and all(r["taken"] <= 2 * r["size"] for r in got.values())


def test_op5(spark, documents):
    got = rows_of(spark, "op5_suffixes", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    for i, t, kept in zip(documents.doc_id, documents.text, removed(documents.text)):
        assert got[i]["n_bytes"] == len((t or "").encode()) and got[i]["n_removed"] == got[i]["n_bytes"] - len(kept) and got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_op6(spark, documents):
    got = rows_of(spark, "op6_lines", "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
    texts = dict(zip(documents.doc_id, documents.text))
    assert all(r["n_lines"] == len((texts[i] or "").split("\n")) and (r["n_dropped"] or r["kept_sha256"] == sha(texts[i] or "")) for i, r in got.items())
    # equal normalised lines of five words or more: all but the first go
    first, gone = set(), dict.fromkeys(texts, 0)
    for i in sorted(texts):
        for line in (texts[i] or "").split("\n"):
            words = re.sub(r"[\W_]+", " ", line.lower()).split()
            if len(words) >= 5 and line.isascii():
                gone[i] += tuple(words) in first
                first.add(tuple(words))
    assert all(got[i]["n_dropped"] >= n for i, n in gone.items())


def test_op7(spark):
    out = queries.QUERIES["op7_neighbours"](spark, SF)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    table = pd.read_parquet(f"{SF}/embeddings.parquet")
    at = {i: np.array(v, float) for i, v in zip(table.vec_id, table.embedding) if v is not None and np.isfinite(np.array(v, float)).all() and np.any(v)}
    rows, hits = out.collect(), 0
    for q in {r["query_id"] for r in rows}:
        own = [r for r in rows if r["query_id"] == q]
        near = sorted((np.sqrt(((at[q] - v) ** 2).sum()), i) for i, v in at.items() if i != q)[:10]
        assert [r["rank"] for r in sorted(own, key=lambda r: (r["score"], r["vec_id"]))] == list(range(1, len(near) + 1))
        assert all(r["score"] == pytest.approx(np.sqrt(((at[q] - at[r["vec_id"]]) ** 2).sum()), rel=1e-12) for r in own)
        hits += len({i for _, i in near} & {r["vec_id"] for r in own})
    assert {r["query_id"] for r in rows} == {i for i in at if i % 100 == 0} and hits >= 0.9 * len(rows)


def test_op8(spark, documents):
    rules = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]
    got = rows_of(spark, "op8_secrets", "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    for i, t in zip(documents.doc_id, documents.text):
        found = sorted((m.start(), k, m.end(), n) for k, (n, p, g, least) in enumerate(rules) for m in p.finditer(t or "") if len(m.group(g)) >= least)
        listed = [f"{n}:{a}:{b}" for a, _, b, n in found]
        assert got[i]["base_sha256"] == sha(",".join(listed)) and [got[i][f"n_{n}"] for n, *_ in rules] == [sum(x[3] == n for x in found) for n, *_ in rules]
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}


def test_op9(spark, documents):
    import xxhash

    got = rows_of(spark, "op9_simhash", "doc_id bigint, fingerprint string, component_id bigint")
    fps = []
    for t in documents.text:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), seed=42) for i in range(max(1, len(w) - 2))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    ids = documents.doc_id.tolist()
    v = np.array(fps, np.uint64)
    want = components_of(np.bitwise_count(v[:, None] ^ v[None, :]) <= 2)
    assert [(got[i]["fingerprint"], got[i]["component_id"]) for i in ids] == [(f"{f:016x}", ids[c]) for f, c in zip(fps, want)]


def test_op10(spark):
    out = queries.QUERIES["op10_chat"](spark, "/root/testdata/sf0.01")
    assert [c for c, _ in out.dtypes] == ["conv_id", "turn", "role", "role_found", "n_rendered", "rendered_sha256"]
    # conversations that the model has not learned from
    from tickertide.llm.common import is_held_out

    share = out.where(is_held_out(F.col("conv_id")) & F.col("role").isin(*chat.ROLES)).agg(F.avg((F.col("role") == F.col("role_found")).cast("double"))).first()[0]
    assert share >= 0.95
