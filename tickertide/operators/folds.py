"""The last accepted close of each symbol, by a fold that runs over blocks at once.

Whether a bar is accepted hangs on the last accepted one before it, so a plain fold has to pass a symbol's bars by one
after another. Here all bars are sorted once by symbol and time and cut into blocks of like size anywhere, so a symbol
with most of the bars is spread over as many tasks as it fills. Each block is folded from a guess: the last sound
close of the block before it. Then the guesses are checked against the ends of the blocks before, and only blocks
whose guess failed are folded again, until all agree. Guesses fail where a block ends in bars that are not accepted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tickertide.sources.shared import park, unpark

MAX_PERCENT = 20.0


def accept(close: np.ndarray, ok: np.ndarray, last: float | None, max_percent: float = MAX_PERCENT) -> tuple[np.ndarray, np.ndarray, float | None]:
    """Closes in order (NaN where there is none) -> (the last accepted close before each, NaN for none; accepted; the last one).

    A bar is accepted if it is ok, its close is above 0, and that moved no more than max_percent from the last accepted
    one, if there is one. So the last accepted close is above 0 always, and no close is divided by 0.
    """
    at = np.nonzero(ok & (close > 0))[0]
    c = close[at]
    taken = np.zeros(len(c), bool)
    # where a close is too far from the one before it: between these all are accepted, once one is
    far = 1 + np.nonzero(np.abs(c[1:] - c[:-1]) / c[:-1] * 100 > max_percent)[0]

    def next_near(k: int, held: float) -> int:
        step = 64
        while k < len(c):
            near = np.nonzero(~(np.abs(c[k : k + step] - held) / held * 100 > max_percent))[0]
            if len(near):
                return k + int(near[0])
            k, step = k + step, step * 2
        return k

    held = last
    k = 0 if held is None else next_near(0, held)
    while k < len(c):
        stop = np.searchsorted(far, k, "right")
        end = int(far[stop]) if stop < len(far) else len(c)
        taken[k:end] = True
        held = float(c[end - 1])
        k = next_near(end, held)
    accepted = np.zeros(len(close), bool)
    accepted[at[taken]] = True
    known = np.concatenate([[np.nan if last is None else last], close[accepted]])
    return known[np.cumsum(accepted) - accepted], accepted, held


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def _folded(rows: DataFrame, starts: DataFrame, max_percent: float) -> DataFrame:
    """rows (part, at, packed) of the parts in starts (part, start: what is held when its first symbol goes on) -> the same with last_close, accepted."""
    schema = StructType([*rows.schema.fields, StructField("last_close", DoubleType()), StructField("accepted", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, symbol, held = None, None, None
        for batch in batches:
            *kept, starts_at = batch.columns
            parts, packed = kept[0].to_numpy(), kept[2]
            names = packed.field("symbol").to_pylist()
            close, ok = _floats(packed.field("close")), packed.field("ok").fill_null(False).to_numpy(zero_copy_only=False)
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1] or parts[i] != parts[i - 1]), len(names)]
            before, accepted = [], []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part:
                    held = starts_at[a].as_py()
                elif names[a] != symbol:
                    held = None
                part, symbol = parts[a], names[a]
                x, y, held = accept(close[a:b], ok[a:b], held, max_percent)
                before.append(x)
                accepted.append(y)
            last = np.concatenate(before) if before else np.empty(0)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(last, pa.float64(), mask=np.isnan(last)), pa.array(np.concatenate(accepted) if accepted else [], pa.bool_())], schema=pa.schema([*(pa.field(n, c.type) for n, c in zip(("part", "at", "packed"), kept)), pa.field("last_close", pa.float64()), pa.field("accepted", pa.bool_())]))

    return rows.join(starts, "part").select(*rows.columns, "start").repartition("part").sortWithinPartitions("part", "at").mapInArrow(run, schema)


def with_last_valid(bars: DataFrame, max_percent: float = MAX_PERCENT, blocks: int | None = None) -> DataFrame:
    """bars (symbol, bar_ts, close, ok) -> the same with last_close (of the last accepted bar before) and accepted, as accept() has it.

    blocks: how many to cut the bars into; Spark's choice by size if not given. Bars alike in all four columns stand in
    one block. Null times come first, a null symbol is one of its own; columns last_close and accepted are replaced.
    """
    spark = bars.sparkSession
    bars = bars.drop("last_close", "accepted")
    order = ["symbol", "bar_ts", "close", "ok"]
    dealt = bars.repartitionByRange(blocks, *order) if blocks else bars.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).select(F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("at"), F.struct(*bars.columns).alias("packed"))
    dealt = park(dealt, "dealt")
    sound = F.coalesce(F.col("packed.ok"), F.lit(False)) & (F.col("packed.close") > 0) & ~F.isnan(F.col("packed.close").cast("double"))
    name, close = F.col("packed.symbol"), F.col("packed.close").cast("double")
    seen = dealt.groupBy("part").agg(F.min_by(name, "at").alias("first"), F.max_by(name, "at").alias("last"), F.max_by(F.when(sound, F.struct(name.alias("symbol"), close.alias("close"))), F.when(sound, F.col("at"))).alias("guess"))
    one_after_another = Window.orderBy("part")  # a row for each block
    goes_on = F.col("first").eqNullSafe(F.lag("last").over(one_after_another)) & (F.row_number().over(one_after_another) > 1)
    guess = F.lag("guess").over(one_after_another)
    chain = park(seen.select("part", "first", "last", goes_on.alias("goes_on"), F.when(goes_on & guess["symbol"].eqNullSafe(F.col("first")), guess["close"]).alias("start")), "chain")
    starts, done, last_round, k = chain.select("part", "start"), [], None, 0
    while True:
        out = park(_folded(dealt, starts, max_percent), "folded")
        done.append(out)
        now = starts.withColumn("round", F.lit(k))
        last_round = now if last_round is None else last_round.join(starts.select("part"), "part", "left_anti").unionByName(now)
        last_round = park(last_round, "rounds")
        folded = reduce_union([o.withColumn("round", F.lit(i)) for i, o in enumerate(done)]).join(last_round.select("part", "round"), ["part", "round"])
        # what a block ends on: its last accepted close of its last symbol, or what it began with if it has but one symbol
        ends = folded.where("accepted").groupBy("part").agg(F.max_by(F.struct(name.alias("symbol"), close.alias("close")), "at").alias("e"))
        ends = chain.join(last_round.select("part", F.col("start").alias("began")), "part").join(ends, "part", "left")
        same = F.col("first").eqNullSafe(F.col("last"))
        end = F.when(F.col("e").isNotNull() & F.col("e.symbol").eqNullSafe(F.col("last")), F.col("e.close")).when(same, F.col("began"))
        want = F.when(F.col("goes_on"), F.lag(end).over(one_after_another))
        failed = park(ends.select("part", "began", want.alias("start")).where("not (began <=> start)").select("part", "start"), "failed")
        if failed.isEmpty():
            break
        starts, k = failed, k + 1
    out = park(folded.select("packed.*", "last_close", "accepted"), "accepted") if k else done[0].select("packed.*", "last_close", "accepted")
    unpark(spark, dealt, chain, *(done if k else ()))
    return out


def reduce_union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out
