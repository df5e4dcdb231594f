"""Correlations of very many symbols as blocked Gram matrices.

Symbols are numbered and cut into blocks of `width`. A return goes to each pair of blocks that its symbol has part in,
there to one of `stripes` by a hash of its time; a task holds the returns of up to `times` times as two dense matrices
and adds their products to six sums for each pair of symbols. So a return is sent once for each block of symbols, not
once for each symbol, and what comes out are sums: no row for a pair and a time is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDTH, STRIPES, TIMES = 256, 16, 1024
_SUMS = ("n", "x", "y", "xx", "yy", "xy")


class Gram:
    """The sums of one pair of blocks in one stripe."""

    def __init__(self, i: int, j: int, width: int):
        self.i, self.j, self.sums = i, j, {s: np.zeros((width, width)) for s in _SUMS}

    def add(self, symbol: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """Returns of whole times: a time's returns must come together."""
        width = len(self.sums["n"])
        _, row = np.unique(at, return_inverse=True)
        sides = []
        for block in (self.i, self.j):
            own = symbol // width == block
            dense, there = np.zeros((row.max() + 1, width)), np.zeros((row.max() + 1, width))
            dense[row[own], symbol[own] % width], there[row[own], symbol[own] % width] = value[own], 1.0
            sides.append((dense, there))
        (x, in_x), (y, in_y) = sides
        for name, a, b in (("n", in_x, in_y), ("x", x, in_y), ("y", in_x, y), ("xx", x * x, in_y), ("yy", in_x, y * y), ("xy", x, y)):
            self.sums[name] += a.T @ b

    def rows(self) -> pa.RecordBatch:
        a, b = np.nonzero(self.sums["n"])
        if self.i == self.j:
            a, b = a[a < b], b[a < b]
        width = len(self.sums["n"])
        return pa.RecordBatch.from_arrays([pa.array(self.i * width + a, pa.int64()), pa.array(self.j * width + b, pa.int64()), *(pa.array(self.sums[s][a, b]) for s in _SUMS)], ["a", "b", *_SUMS])


def _summed(width: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, held = None, None

        def flush(rows: np.ndarray, all_of_it: bool) -> np.ndarray:
            """Add the times that are whole; what may go on stays."""
            end = len(rows[1]) if all_of_it else int(np.searchsorted(rows[1], rows[1][-1]))
            if end:
                gram.add(rows[0][:end].astype(np.int64), rows[1][:end], rows[2][:end])
            return [r[end:] for r in rows]

        for batch in batches:
            i, j, stripe, at, symbol, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.nonzero((np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(stripe) != 0))[0] + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(i)]):
                key = (int(i[lo]), int(j[lo]), int(stripe[lo])) if lo < hi else None
                if key is None:
                    continue
                if gram is None or key != gram_key:
                    if gram is not None:
                        flush(held, True)
                        yield gram.rows()
                    gram, gram_key, held = Gram(*key[:2], width), key, [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
                # steps of so many rows hold no more than `times` whole times and one that goes on
                for k in range(lo, hi, times):
                    held = [np.concatenate([h, new[k : min(hi, k + times)]]) for h, new in zip(held, (symbol, at, value))]
                    held = flush(held, False)
        if gram is not None:
            flush(held, True)
            yield gram.rows()

    return run


def gram_correlations(returns: DataFrame, width: int = WIDTH, stripes: int = STRIPES, times: int = TIMES) -> DataFrame:
    """returns (symbol, bar_ts, ret) -> symbol_a < symbol_b, correlation, n, for symbols that share a time.

    One return a symbol and time; of more, one counts. Returns that are null or not a number, and null symbols or
    times, are left out. The correlation is null where one of both does not change over the times they share.
    """
    rows = returns.where("symbol is not null and bar_ts is not null and ret is not null and not isnan(ret)").select("symbol", F.xxhash64("bar_ts").alias("hash"), F.unix_micros(F.col("bar_ts").cast("timestamp")).alias("at"), F.col("ret").cast("double").alias("ret"))
    # one row for each symbol goes through the window
    names = rows.select("symbol").distinct().select("symbol", (F.row_number().over(Window.orderBy("symbol")) - 1).cast("long").alias("k"))
    blocks = -(-rows.select("symbol").distinct().count() // width)
    own = F.floor(F.col("k") / width)
    pairs = F.transform(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0))), lambda o: F.struct(F.least(own, o.cast("long")).alias("i"), F.greatest(own, o.cast("long")).alias("j")))
    dealt = rows.join(names, "symbol").select("k", "at", "ret", F.pmod("hash", F.lit(stripes)).alias("stripe"), F.inline(pairs))
    dealt = dealt.select("i", "j", "stripe", "at", "k", "ret").repartition("i", "j", "stripe").sortWithinPartitions("i", "j", "stripe", "at")
    sums = dealt.mapInArrow(_summed(width, times), "a long, b long, " + ", ".join(f"{s} double" for s in _SUMS)).groupBy("a", "b").agg(*(F.sum(s).alias(s) for s in _SUMS))
    part = lambda s: F.col("n") * F.col(s * 2) - F.col(s) * F.col(s)
    corr = (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.nullif(F.sqrt(F.greatest(part("x"), F.lit(0.0)) * F.greatest(part("y"), F.lit(0.0))), F.lit(0.0))
    name = lambda k: names.select(F.col("k").alias(k), F.col("symbol").alias(f"symbol_{k}"))
    return sums.withColumn("correlation", corr).join(name("a"), "a").join(name("b"), "b").select("symbol_a", "symbol_b", "correlation", F.col("n").cast("long").alias("n"))
