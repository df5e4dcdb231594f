"""Secret scans in DataFrame functions: three fixed rules, and windowed entropy over candidate strings.

Matches are found leftmost and non-overlapping by a lazy gap before the rule's pattern, so the lengths of gaps and
matches add up to positions in code points. The method looks at runs of token letters of MIN_RUN or more:
each run is of a character class by the cases and digits it holds, a window of WINDOW characters slides over it, and
both the window's character counts and the sum of c * log2(c) over them are kept up to date by the character that
leaves and the one that enters. A run whose greatest window entropy reaches its class's threshold is a span, unless it
is allow-listed or lies within a span of a fixed rule.

Null text counts as empty and has no spans. Texts, runs and the number of matches may be of any size: the work grows
in proportion. Spans of equal start go by the order of the rules. Repeated rows give repeated results; other columns,
whatever their names, are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import let

#: The fixed rules: kind, pattern with the value as its only group, least length of that value.
RULES = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"(AKIA[A-Z0-9]+)", 16),
    ("hex", r"([0-9a-f]+)", 32),
)
#: What a rule's match must hold somewhere: texts without it skip the rule.
NEEDS = {"assign": r"(?i:passw|secret|token|api_?key)", "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}
TOKEN = r"A-Za-z0-9+/_=-"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Items that one fold gathers: appending copies what is there.
CHUNK = 256
MIN_RUN, WINDOW = 20, 20
RUN = rf"(?<![{TOKEN}])([{TOKEN}]{{{MIN_RUN},}})"
#: Character class, what its runs look like, and the window entropy (bits) from which a run is a secret.
CLASSES = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("mixed", r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).*$", 3.6),
    ("lower and digits", r"^(?=.*[a-z])(?=.*[0-9]).*$", 3.5),
    ("upper and digits", r"^(?=.*[A-Z])(?=.*[0-9]).*$", 3.4),
    ("both cases", r"^(?=.*[a-z])(?=.*[A-Z]).*$", 3.7),
    ("one case", r"", 3.5),
)
#: Runs that look random and are none: UUIDs, words joined by marks, counters, placeholders. Possessive, so that long runs need no stack.
ALLOWED = r"(?i:^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^(?:[a-z]++[-_/+=])++[a-z]*+[0-9]*+$|0123456789|abcdefgh|example|placeholder|^[0-9_/+=-]+$)"
_SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The values joined from the first on, as sums or maxima; in chunks, so that the work grows in proportion."""

    def small(xs: Column) -> Column:
        start = F.struct(F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("all"))

        def step(acc: Column, x: Column) -> Column:
            now = F.when(acc["last"].isNull(), x).otherwise(join(acc["last"], x))
            return F.struct(now.alias("last"), F.array_append(acc["all"], now).alias("all"))

        return F.aggregate(xs, start, step)["all"]

    def whole(xs: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(CHUNK)), lambda i: small(F.slice(xs, i, CHUNK)))
        return let(parts, lambda ps: let(small(F.transform(ps, lambda p: F.element_at(p, -1))), lambda ends: F.flatten(F.transform(ps, lambda p, k: F.when(k == 0, p).otherwise(F.transform(p, lambda v: join(ends[k - 1], v)))))))

    return let(values, lambda xs: F.when(F.size(xs) > 0, whole(xs)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: str, needs: str, least: int = 0) -> Column:
    """array of (start, end, value): the pattern's leftmost non-overlapping matches whose value, its group, is long enough."""
    # the end of the text ends the last gap; without it each place after the last match would be tried as a start
    lazy = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    parts = F.arrays_zip(*(F.regexp_extract_all(text, lazy, F.lit(k)).alias(n) for k, n in ((1, "gap"), (2, "hit"))))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = F.filter(parts, lambda x: x["hit"] != "")

    def placed(xs: Column) -> Column:
        ends = running(F.transform(xs, lambda x: F.length(x["gap"]) + F.length(x["hit"])), lambda a, b: a + b)
        # a hit taken alone matches as it did in the text
        return let(ends, lambda es: F.transform(xs, lambda x, i: F.struct((es[i] - F.length(x["hit"])).alias("start"), es[i].alias("end"), F.regexp_extract(x["hit"], pattern, 1).alias("value"))))

    return F.when(text.rlike(needs), F.filter(let(parts, placed), lambda x: F.length(x["value"]) >= least)).otherwise(none)


def _weight(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def entropy(run: Column, width: int = WINDOW) -> Column:
    """The greatest Shannon entropy of the windows of a run of LETTERS, from counts kept up to date.

    The counts are a string with one letter for each of LETTERS, A for none, B for one, and so on.
    """
    place = lambda ch: F.position(ch, F.lit(LETTERS))
    count = lambda counts, ch: F.ascii(F.substr(counts, place(ch), F.lit(1))) - 65
    put = lambda counts, ch, c: F.overlay(counts, F.char(c + 65), place(ch), F.lit(1))

    def enter(acc: Column, ch: Column) -> Column:
        c = count(acc["counts"], ch)
        return F.struct(put(acc["counts"], ch, c + 1).alias("counts"), (acc["now"] - _weight(c) + _weight(c + 1)).alias("now"), acc["least"].alias("least"))

    def leave(acc: Column, ch: Column) -> Column:
        c = count(acc["counts"], ch)
        return F.struct(put(acc["counts"], ch, c - 1).alias("counts"), (acc["now"] - _weight(c) + _weight(c - 1)).alias("now"), acc["least"].alias("least"))

    def scanned(chars: Column) -> Column:
        n = F.size(chars)
        none = F.struct(F.lit("A" * len(LETTERS)).alias("counts"), F.lit(0.0).alias("now"), F.lit(0.0).alias("least"))
        first = let(F.aggregate(F.slice(chars, 1, width), none, enter), lambda s: F.struct(s["counts"].alias("counts"), s["now"].alias("now"), s["now"].alias("least")))

        def step(acc: Column, i: Column) -> Column:
            moved = let(leave(acc, chars[i - width]), lambda s: enter(s, chars[i]))
            return let(moved, lambda s: F.struct(s["counts"].alias("counts"), s["now"].alias("now"), F.least(s["least"], s["now"]).alias("least")))

        moves = F.when(n > width, F.sequence(F.lit(width), n - 1)).otherwise(F.array().cast("array<int>"))
        width_ = F.least(n, F.lit(width)).cast("double")
        return F.log2(width_) - F.aggregate(moves, first, step)["least"] / width_

    return let(F.filter(F.split(run, ""), lambda ch: ch != ""), scanned)


def _is_random(run: Column) -> Column:
    limit = F.lit(None).cast("double")
    for _, looks, bits in reversed(CLASSES):
        limit = F.when(run.rlike(looks), F.lit(bits)).otherwise(limit)
    return F.coalesce(~run.rlike(ALLOWED) & (entropy(run) >= limit), F.lit(False))


def _upto(sorted_: Column, v: Column) -> Column:
    """How many of the sorted numbers are v or less, by halving."""
    steps = F.sequence(F.lit(1), F.lit(32))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        ahead = F.coalesce(F.get(sorted_, mid) <= v, F.lit(False))
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & ahead, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(open_ & ~ahead, mid).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(sorted_).alias("hi")), step)["lo"]


def _rule(text: Column, rank: int, kind: str, pattern: str, least: int) -> Column:
    found = matches(text, pattern, NEEDS[kind], least)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base and added: arrays of (start, rank, end, kind), sorted; ends are exclusive, in code points."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    for rank, (kind, pattern, least) in enumerate(RULES):
        rows = rows.withColumn(f"_{kind}", _rule(F.col("_text"), rank, kind, pattern, least))
    base = F.array_sort(F.concat(*(F.col(f"_{kind}").cast(f"array<{_SPAN}>") for kind, _, _ in RULES)))
    rows = rows.withColumn("base", base).withColumn("_runs", matches(F.col("_text"), RUN, RUN))
    # to what end the base spans reach that start by then: a run that ends no later lies within one of them
    reach = running(F.transform("base", lambda b: b["end"]), F.greatest)
    inside = lambda m, starts, ends: F.coalesce(F.get(ends, _upto(starts, m["start"]) - 1) >= m["end"], F.lit(False))
    new = let(F.transform("base", lambda b: b["start"]), lambda starts: let(reach, lambda ends: F.filter("_runs", lambda m: ~inside(m, starts, ends) & _is_random(m["value"]))))
    added = F.transform(new, lambda m: F.struct(m["start"].alias("start"), F.lit(len(RULES)).alias("rank"), m["end"].alias("end"), F.lit("entropy").alias("kind")))
    return rows.select(id_col, "base", added.cast(f"array<{_SPAN}>").alias("added"))


def listed(found: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
