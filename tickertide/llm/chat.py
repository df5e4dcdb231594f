"""Chat formatting: a hidden Markov model recovers each turn's role, then turns are rendered in one form.

What is observed of a turn: the speaker marker its first line begins with, if any ("User:", "Q:", "### Assistant"
and the like), and features of its lines: how long it is, how many lines, whether it ends in a question. The hidden
states are the roles. Start, transition and emission counts come from all rows with a known role; a turn's own role is
never looked at when it is decoded.

Viterbi runs in segments of SEGMENT turns by turn number, so that one endless transcript is not one task: each segment
gives the matrix of best log probabilities from the state before it to the state at its end, the matrices of a
transcript are run through in order (one small row a segment) to fix the states at segment ends, and each segment is
then decoded between its fixed ends. The result is that of one pass over the whole transcript.

Null text counts as empty; null turns sort first; rows with a null transcript id form one transcript; equal turn
numbers are ordered by text. Roles other than ROLES and null are not learned from. Repeated rows are turns of their
own. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import park

ROLES = ("system", "user", "assistant")
#: Speaker markers at the head of a turn, by the role they name.
MARKERS = (
    ("system", r"(?i)^\s*(?:#{1,4}\s*|\[|<\|?)?(?:system|instructions?)(?:\]|\|?>|\s*:)"),
    ("user", r"(?i)^\s*(?:#{1,4}\s*|\[|<\|?)?(?:user|human|customer|question|q)(?:\]|\|?>|\s*:)"),
    ("assistant", r"(?i)^\s*(?:#{1,4}\s*|\[|<\|?)?(?:assistant|bot|ai|agent|answer|a)(?:\]|\|?>|\s*:)"),
)
SEGMENT, LENGTHS, LINES = 256, 16, 6
N_OBSERVED = 4 * LENGTHS * LINES * 2


def observed(text: Column) -> Column:
    """One number for the marker, the length (by powers of two), the number of lines and the question mark."""
    marker = F.lit(0)
    for i, (_, pattern) in enumerate(MARKERS):
        marker = F.when(text.rlike(pattern), i + 1).otherwise(marker)
    length = F.least(F.floor(F.log2(F.length(text) + F.lit(1.0)) * 1.25), F.lit(LENGTHS - 1))
    lines = F.least(F.size(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")), F.lit(LINES - 1))
    asks = text.rlike(r"\?\s*$").cast("int")
    return (((marker * LENGTHS + length) * LINES + lines) * 2 + asks).cast("int")


def body(text: Column) -> Column:
    """The text without the speaker marker and outer white space."""
    for _, pattern in MARKERS:
        text = F.regexp_replace(text, pattern, "")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), body(text), F.lit("\n<|end|>\n"))


def turns(chats: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str | None = "role") -> DataFrame:
    role = F.col(role_col) if role_col else F.lit(None).cast("string")
    rows = chats.select(F.col(id_col).cast("string").alias("chat"), F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), role.alias("role"))
    return rows.withColumn("segment", F.floor(F.coalesce("turn", F.lit(-1)) / SEGMENT)).withColumn("seen", observed(F.col("text")))


def learn(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities (start, transition, emission) from rows of turns() with a role, by counts with one added.

    The features are taken as independent given the role. Pairs of turns are counted within segments. What comes to
    the driver is counts by role and observation, of a fixed number.
    """
    known = rows.where(F.col("role").isin(*ROLES)).select("chat", "segment", "turn", "role", "seen")
    at = {r: i for i, r in enumerate(ROLES)}
    before = F.lag("role").over(Window.partitionBy("chat", "segment").orderBy("turn", "seen"))
    n, start, move, emit = len(ROLES), np.ones(len(ROLES)), np.ones((len(ROLES),) * 2), [np.ones((len(ROLES), k)) for k in (4, LENGTHS, LINES, 2)]
    for r in known.withColumn("before", before).groupBy("before", "role", F.col("segment") <= 0, "seen").count().toLocalIterator():
        b, role, first, seen, c = r
        if b is not None:
            move[at[b], at[role]] += c
        elif first:
            start[at[role]] += c
        for table, v in zip(emit, (seen // (LENGTHS * LINES * 2), seen // (LINES * 2) % LENGTHS, seen // 2 % LINES, seen % 2), strict=True):
            table[at[role], v] += c
    logs = [np.log(t / t.sum(1, keepdims=True)) for t in emit]
    emission = (logs[0][:, :, None, None, None] + logs[1][:, None, :, None, None] + logs[2][:, None, None, :, None] + logs[3][:, None, None, None, :]).reshape(n, N_OBSERVED)
    return np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), emission


def _through(before: np.ndarray, move: np.ndarray, emission: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Viterbi step for several rows of scores at once: (scores, best earlier state)."""
    options = before[..., :, None] + move
    return options.max(-2) + emission, options.argmax(-2)


def _groups(batches, keys: int):
    """Runs of rows of equal leading columns in a sorted stream, as (key, list of rows)."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield key, rows


def _batches(rows, names: list[str], types: list[pa.DataType], size: int = 2000):
    out = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def recover(rows: DataFrame, start: np.ndarray, move: np.ndarray, emission: np.ndarray) -> DataFrame:
    """rows of turns() -> the same with found, the role by Viterbi."""
    n = len(ROLES)
    # a first turn has no turn before it: its matrix takes the start for every state before
    first = rows.groupBy("chat").agg(F.min("segment").alias("segment")).withColumn("head", F.lit(True))
    keyed = rows.join(first.withColumnRenamed("chat", "c").withColumnRenamed("segment", "s"), F.col("chat").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left").drop("c", "s").withColumn("head", F.coalesce("head", F.lit(False)))
    keyed = park(keyed, "turns")

    def matrices(batches):
        def each():
            key, m = None, None
            for batch in batches:
                for chat, segment, head, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (chat, segment) != key:
                        if key is not None:
                            yield *key, m.ravel().tolist()
                        key = chat, segment
                        m = np.tile(start + emission[:, seen], (n, 1)) if head else move + emission[:, seen]
                    else:
                        m = _through(m, move, emission[:, seen])[0]
            if key is not None:
                yield *key, m.ravel().tolist()

        yield from _batches(each(), ["chat", "segment", "m"], [pa.string(), pa.int64(), pa.list_(pa.float64())])

    def ends(batches):
        def each():
            for (chat,), segments in _groups(batches, 1):
                score, back = np.zeros(n), []
                for _, _, m in segments:
                    options = score[:, None] + np.array(m).reshape(n, n)
                    back.append(options.argmax(0))
                    score = options.max(0)
                    score -= score.max()
                state = int(score.argmax())
                for (_, segment, _), b in zip(reversed(segments), reversed(back), strict=True):
                    yield chat, segment, int(b[state]), state
                    state = int(b[state])

        yield from _batches(each(), ["chat", "segment", "enter", "leave"], [pa.string(), pa.int64(), pa.int32(), pa.int32()])

    def decode(batches):
        for (_, _), turns_ in _groups(batches, 2):
            head, enter, leave = turns_[0][2:5]
            score, back = (start if head else move[enter]) + emission[:, turns_[0][5]], []
            for t in turns_[1:]:
                score, b = _through(score, move, emission[:, t[5]])
                back.append(b)
            state, found = leave, [leave]
            for b in reversed(back):
                state = int(b[state])
                found.append(state)
            yield from _batches(((*t[6:], ROLES[s]) for t, s in zip(turns_, reversed(found), strict=True)), names, types)

    order = ["chat", "segment", "turn", "text"]
    by_segment = keyed.select("chat", "segment", "head", "seen", "turn", F.col("text")).repartition("chat", "segment").sortWithinPartitions(*order).select("chat", "segment", "head", "seen")
    steps = by_segment.mapInArrow(matrices, "chat string, segment long, m array<double>")
    fixed = steps.repartition("chat").sortWithinPartitions("chat", "segment").mapInArrow(ends, "chat string, segment long, enter int, leave int")
    fixed = fixed.select(F.col("chat").alias("c"), F.col("segment").alias("s"), "enter", "leave")
    joined = keyed.join(fixed, F.col("chat").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")))
    kind = rows.schema["id"].dataType
    names = ["id", "turn", "text", "role", "found"]
    types = [pa.int64() if kind.simpleString() == "bigint" else pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    ident = F.col("id") if kind.simpleString() == "bigint" else F.col("id").cast("string").alias("id")
    schema = f"id {'long' if kind.simpleString() == 'bigint' else 'string'}, turn long, text string, role string, found string"
    found = joined.repartition("chat", "segment").sortWithinPartitions(*order).select("chat", "segment", "head", "enter", "leave", "seen", ident, "turn", "text", "role").mapInArrow(decode, schema)
    return found.withColumn("id", F.col("id").cast(kind))


def format_chats(chats: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role", known: DataFrame | None = None) -> DataFrame:
    """Per turn: id, turn, role (as given), found (by the model), rendered. known: rows to learn from, else chats."""
    rows = turns(chats, id_col, turn_col, text_col, role_col)
    model = learn(rows if known is None else turns(known, id_col, turn_col, text_col, role_col))
    return recover(rows, *model).select(F.col("id").alias(id_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "found", render(F.col("found"), F.col("text")).alias("rendered"))
