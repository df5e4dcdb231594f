"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the mean of its words' vectors, a word the mean of the vectors of its character n-grams (3 to 6, with word
ends marked), n-grams share hashed buckets, and a softmax over two classes stands on the mean. Bucket vectors and
softmax are trained jointly by Adam in numpy, so a misspelling never seen is still near words with which it
shares n-grams.

The model is fitted on at most SAMPLE labelled rows, those of least hash, which bounds the driver's work at any input
size; a row's whole text counts. Scoring is linear in the mean, so each bucket comes down to one number, each distinct
word to one number too, and a text to a mean of numbers.

Null and empty texts, and texts of punctuation alone, have no words: they score what the bias says. Labels other than
0 and 1 and null labels or ids are not learned from; with no rows of one of the classes every score is that of the
prior. Repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import is_held_out

#: Labelled rows to fit on, at most, and the characters of all of them together, after which no further row is added.
SAMPLE, SAMPLE_CHARS = 8000, 32_000_000
BUCKETS, DIM, GRAMS = 1 << 18, 4, (3, 4, 5, 6)
EPOCHS, BATCH, RATE, DECAY, MIN_DOCS, POSITIVE = 10, 128, 0.02, 3e-4, 20, 1.5
#: Steps at least.
STEPS = 400
#: Empty words that each mean also runs over: the few words of a short text don't decide alone.
PAD = 30
#: Texts' means are multiplied by this before the softmax: the mean of some hundred words is short.
SCALE = 50.0
CACHE_WORDS = 400_000
WORD = re.compile(r"[^\W_]+")


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, owning word), in order of words: n-grams of UTF-32 letters, hashed in numpy."""
    letters = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    mixed = (letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h, found, owners = mixed.copy(), [], []
    for n in range(2, max(GRAMS) + 1):
        if len(letters) < n:
            break
        h = (h[:-1] * np.uint64(0x100000001B3)) ^ mixed[n - 1 :]
        if n in GRAMS:
            inside = owner[n - 1 :] == owner[: len(h)]
            v = h[inside] * np.uint64(0xD6E8FEB86659FD93)
            found.append((v >> np.uint64(64 - 18)).astype(np.int64) % BUCKETS)
            owners.append(owner[: len(h)][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b, o = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return b[order], o[order]


@dataclass
class Model:
    """bucket: what a bucket adds to the log odds of class 1, before averaging; bias: the log odds of no words."""

    bucket: np.ndarray
    bias: float


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares): how much of the text's mean each bucket's vector makes up."""
    words = WORD.findall(text.lower())
    count = Counter(words)
    grams, owner = gram_buckets(list(count))
    n = np.maximum(1, np.bincount(owner, minlength=len(count)))
    share = np.fromiter(count.values(), np.float64, len(count)) / n / (len(words) + PAD)
    buckets, at = np.unique(grams, return_inverse=True)
    return buckets.astype(np.int32), np.bincount(at, share[owner], len(buckets)).astype(np.float32)


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, dim: int = DIM, seed: int = 0) -> Model:
    y = np.array(labels, np.int64)
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), prior)
    rows, seen = [], np.zeros(BUCKETS, np.int32)
    for t in texts:
        rows.append(features(t))
        seen[rows[-1][0]] += 1
    kept = np.flatnonzero(seen >= min(MIN_DOCS, max(2, len(rows) // 100)))  # what few texts have would be learned by heart
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    for i, (b, v) in enumerate(rows):  # in place: the driver never holds both forms of all rows
        own = place[b] >= 0
        rows[i] = place[b][own], v[own]
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.1 / dim, (len(kept), dim)), rng.normal(0, 0.5, (dim, 2)), np.array([0.0, prior])
    want, weigh = np.eye(2)[y], np.where(y == 1, POSITIVE, 1.0)
    params, m, v, step = [e, w, b], [0.0] * 3, [0.0] * 3, 0
    for _ in range(max(epochs, STEPS * BATCH // len(rows))):  # few rows are gone through more often
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            step += 1
            cols = np.concatenate([rows[i][0] for i in batch])
            share = np.concatenate([rows[i][1] for i in batch])
            doc = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            mean = SCALE * np.stack([np.bincount(doc, e[cols, k] * share, len(batch)) for k in range(dim)], 1)
            z = mean @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            dz = (p / p.sum(1, keepdims=True) - want[batch]) * weigh[batch, None] / len(batch)
            d_mean = SCALE * dz @ w.T
            d_e = np.stack([np.bincount(cols, d_mean[doc, k] * share, len(kept)) for k in range(dim)], 1)
            for k, g in enumerate((d_e + DECAY * e, mean.T @ dz + DECAY * w, dz.sum(0))):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                params[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    bucket = np.zeros(BUCKETS)
    bucket[kept] = SCALE * (e @ (w[:, 1] - w[:, 0]))
    return Model(bucket, float(b[1] - b[0]))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def learn(self, words: list[str]) -> None:
        grams, owner = gram_buckets(words)
        n = np.maximum(1, np.bincount(owner, minlength=len(words)))
        self.cache.update(zip(words, (np.bincount(owner, self.model.bucket[grams], len(words)) / n).tolist(), strict=True))

    def log_odds(self, text: str) -> float:
        words = WORD.findall(text.lower())
        if not words:
            return self.model.bias
        values = list(map(self.cache.get, words))
        if None in values:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
                self.learn(list(set(words)))
            else:
                self.learn(list({w for w, v in zip(words, values, strict=True) if v is None}))
            values = map(self.cache.__getitem__, words)
        return self.model.bias + sum(values) / (len(words) + PAD)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.log_odds(text), -500, 500))))


def unlearned() -> Model:
    """Without a row to learn from nothing counts as toxic: every score is below one half."""
    return Model(fit([], []).bucket, -1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: bool = True, sample: int = SAMPLE) -> Model:
    """Fit on the `sample` labelled rows of least hash; with held_out, rows whose crc32(id) mod 5 is 0 are left out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    if held_out:
        known = known.where(~is_held_out(F.col("id")))
    # chosen by id first, so that only the chosen rows' texts move
    chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", "text").limit(sample)

    def run(batches):
        rows, room = [], SAMPLE_CHARS
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1), strict=True):
                if len(text.as_py() or "") <= room:
                    room -= len(text.as_py() or "")
                    rows.append((text.as_py() or "", y.as_py()))
        model = fit([t for t, _ in rows], [y for _, y in rows]) if rows else unlearned()
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([model.bucket.tobytes()], pa.binary()), "bias": pa.array([model.bias])})

    # one task fits the model on the bounded sample; the driver sees BUCKETS numbers
    found = texts.select("text", "y").repartition(1).mapInArrow(run, "bucket binary, bias double").first()
    return Model(np.frombuffer(bytes(found["bucket"])), found["bias"]) if found else unlearned()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 if score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket, model.bias))  # BUCKETS numbers, whatever the input

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            s = [scorer.score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "score": pa.array(s, pa.float64()), "predicted": pa.array([int(x >= 0.5) for x in s], pa.int32())})

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """docs without the rows that score `limit` or more; all columns stay as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast((model.bucket, model.bias)), docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t.as_py() or "") < limit for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
