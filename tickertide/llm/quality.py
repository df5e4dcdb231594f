"""Quality rules with an isolation forest over their statistics.

Each text gives counts: words, characters in words, symbols, repeated lines, words in repeated 5-word windows. Two
base rules fail a text outright: too few words, or too many words in repeated windows. For the rest the counts become
ratios, and an isolation forest (Liu, Ting and Zhou 2008) cuts random subsamples of them by random splits: rows that
few cuts set apart have short paths, so a score near 1, and are anomalous. The score from which a text is dropped is
calibrated on all labelled rows, by a histogram of scores and labels.

The forest is fitted on the statistics of at most SAMPLE labelled rows (those of least hash). Null text has no words,
so it fails the base rules; so do empty texts. Null labels are not used; without labels of both kinds the forest drops
nothing. Repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import park

MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 10, 5, 20
SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Labelled rows the forest is fitted on at most; trees, rows a tree, and bins of the score histogram.
SAMPLE, TREES, ROWS, BINS = 20_000, 100, 256, 1000
#: Of labelled good texts, the share that calibration may lose at most.
LOSS = 0.002
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACES = bytes([0x20, *range(0x09, 0x0E)])


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """The counts of one text, in the order of COUNTS."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # bytes split on exactly the six ASCII spaces
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, _SPACES)))
    symbols = len(SYMBOLS.findall(text))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACES)]
    repeated = 0
    if n > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        if len(set(windows)) < len(windows):
            count, upto = Counter(windows), 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeated += i + WINDOW - max(i, upto)
                    upto = i + WINDOW
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and COUNTS (long)."""

    def run(batches):
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            cols = zip(*rows, strict=True) if rows else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0)} | {c: pa.array(v, pa.int64()) for c, v in zip(COUNTS, cols, strict=True)})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees: mean word length, symbols a word, symbols a character. Few words scatter, so the first two lean towards what is usual.

    Repeated lines and windows are left to the base rule: below its limit they are rare among good texts and bad ones alike.
    """
    n, chars = np.maximum(counts["n_words"], 1).astype(float), np.maximum(counts["word_chars"], 1)
    return np.stack([(counts["word_chars"] + USUAL_LENGTH * LEAN) / (n + LEAN), counts["n_symbols"] / (n + LEAN), counts["n_symbols"] / chars], 1)


#: The usual mean word length, and the words of that length that each text is given on top.
USUAL_LENGTH, LEAN = 5.0, 80


class Forest:
    """Trees as arrays: the feature split on (-1: a leaf), the split value, the children, and the path length of a leaf."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = ROWS, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        depth = int(np.ceil(np.log2(max(2, self.size))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], depth, rng) for _ in range(trees)]

    @staticmethod
    def usual(n: float) -> float:
        """The mean path length of an unsuccessful search among n rows."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, limit: int, rng) -> tuple[np.ndarray, ...]:
        nodes, todo = [], [(rows, 0, -1, 0)]
        while todo:
            part, depth, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(part) < 2 or not len(open_):
                nodes.append([-1, 0.0, me, me, depth + self.usual(len(part))])
                continue
            f = int(rng.choice(open_))
            at = rng.uniform(low[f], high[f])
            nodes.append([f, at, 0, 0, 0.0])
            left = part[:, f] <= at
            todo += [(part[left], depth + 1, me, 0), (part[~left], depth + 1, me, 1)]
        f, at, left, right, length = zip(*nodes, strict=True)
        return np.array(f), np.array(at), np.array(left), np.array(right), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / usual path length)."""
        total = np.zeros(len(rows))
        for f, at, left, right, length in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (inner := f[node] >= 0).any():
                go = rows[np.arange(len(rows)), f[node]] <= at[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / max(self.usual(self.size), 1e-9))


def judge(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """stats of measure() -> the same with base_failed, score (of the forest) and kept."""
    spark = stats.sparkSession
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    known = labels.where(f"`{label_col}` in (0, 1)").groupBy(F.col(id_col).alias("known_id")).agg(F.min(label_col).cast("int").alias("label"))
    marked = stats.withColumn("base_failed", failed).join(known, F.col(id_col) == F.col("known_id"), "inner").where("not base_failed")
    # written first: a limit that is collected would bring so many rows of each partition to the driver
    chosen = park(marked.orderBy(F.xxhash64("known_id"), "known_id", *COUNTS).limit(sample).select(*COUNTS), "sample").toPandas()
    if len(chosen) < 2:
        return stats.withColumn("base_failed", failed).withColumn("score", F.lit(0.0)).withColumn("kept", ~failed)
    shared = spark.sparkContext.broadcast(Forest(ratios({c: chosen[c].to_numpy() for c in COUNTS})))  # TREES x 2 ROWS nodes at most

    def run(batches):
        for batch in batches:
            counts = {c: batch.column(batch.schema.get_field_index(c)).to_numpy() for c in COUNTS}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(ratios(counts)))], names=[*batch.schema.names, "score"])

    kind = stats.schema[id_col].dataType.simpleString()
    scored = park(stats.select(id_col, *COUNTS).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double"), "scores").withColumn("base_failed", failed)
    bins = scored.where("not base_failed").join(known, F.col(id_col) == F.col("known_id")).groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(threshold([tuple(r) for r in bins.collect()]))))  # BINS rows at most


def threshold(bins: list[tuple[int, int, int]], loss: float = LOSS) -> float:
    """bins (number, good, bad) -> the score from which texts go: most bad minus good texts above it, with few good ones lost."""
    all_good, best, at, good, bad = sum(b[1] for b in bins), 0, 2.0, 0, 0
    for b, g, n in sorted(bins, reverse=True):
        good, bad = good + g, bad + n
        if good > loss * all_good:
            break
        if bad - good > best:
            best, at = bad - good, b / BINS
    return at


def rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, COUNTS, base_failed, score, kept."""
    return judge(park(measure(docs, id_col, text_col), "stats"), labels, id_col)
