"""Spelling variants of the corpus's words, found by PartEnum signatures.

Words are counted over all texts. A word's letters are a binary vector with a dimension for each letter's first, second,
... occurrence; one inserted, deleted or replaced letter flips two dimensions at most. So the dimensions are dealt into
PARTS groups, and a signature is what a word has in all groups but two: words within the distance agree on one of
them. Signatures are joined by equality and pairs verified by their edit distance, which also drops anagrams.

Of a signature's words only those can be one edit apart that agree on their first or last half besides (an edit falls
into one half only), so the signature is split by these: its key takes the half and the length, and many words of the
same letters do not meet. All signatures are split, at every size, and no pair is lost.

Null texts have no words and a null id counts as an empty text before the colon. Repeated rows count again. Texts may
have any length: whole texts are counted, and counts are summed before they are shuffled. Of near words equally frequent
the smallest in code-point order is the form. An empty table gives an empty table. Other columns, whatever their names,
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tickertide.llm.common import park, unpark

MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: A word's occurrences in a document lose a letter where the hash of both is divided by this; 0 leaves all.
NOISE = 97
#: Groups of dimensions, and dimensions that one edit flips.
PARTS, FLIPS = 4, 2
LETTER = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MASK = (1 << 64) - 1


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """word, n: words of so many letters and occurrences."""
    # shorter runs cannot become longer words
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{LETTER}{{{min_chars},}}"), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    word = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("id", word.alias("word"))
    if noise:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod(h, F.length("word")).cast("int")
        runs = runs.select(F.when(h % noise == 0, F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))).otherwise(F.col("word")).alias("word"))
    return runs.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _mixed(x: int) -> int:
    x = x * 0x9E3779B97F4A7C15 & _MASK
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & _MASK
    return x ^ x >> 32


class Signatures:
    """keys(word): those it shares with words of its length or one more, and those it shares with words of one less."""

    def __init__(self, parts: int = PARTS, flips: int = FLIPS):
        self.parts, self.kept = parts, list(combinations(range(parts), parts - flips))
        self.dims: dict[tuple[str, int], tuple[int, int]] = {}

    def groups(self, word: str) -> list[int]:
        """For each group of dimensions a hash of those that the word has."""
        out, seen = [0] * self.parts, {}
        for ch in word:
            k = seen[ch] = seen.get(ch, 0) + 1
            if (ch, k) not in self.dims:
                h = _mixed(ord(ch) << 32 | k)
                self.dims[ch, k] = h % self.parts, _mixed(h)
            group, h = self.dims[ch, k]
            out[group] ^= h
        return out

    def keys(self, word: str) -> tuple[list[int], list[int]]:
        groups, n, own, less = self.groups(word), len(word), [], []
        first, last = word[: n // 2].encode(), word[n // 2 :].encode()
        # halves as a partner of one letter less has them
        first_less, last_less = word[: (n - 1) // 2].encode(), word[(n - 1) // 2 + 1 :].encode()
        of_own, of_less = ((_mixed(m << 1 | 1 << 40), _mixed(m << 1 | 1 << 41)) for m in (n, n - 1))
        for i, kept in enumerate(self.kept):
            mixed = _mixed(i + 1)
            for g in kept:
                mixed = _mixed(mixed ^ groups[g])
            own += [xxh3_64_intdigest(first, mixed ^ of_own[0]), xxh3_64_intdigest(last, mixed ^ of_own[1])]
            less += [xxh3_64_intdigest(first_less, mixed ^ of_less[0]), xxh3_64_intdigest(last_less, mixed ^ of_less[1])]
        return own, less


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """words (word, n) -> word, n, own and less (keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Signatures(parts)
        signed = lambda keys: [k - (1 << 64) if k >> 63 else k for k in keys]
        for batch in batches:
            own, less = zip(*(map(signed, made.keys(w)) for w in batch.column(0).to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.int64())), pa.array(less, pa.list_(pa.int64()))], ["word", "n", "own", "less"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, own array<long>, less array<long>")


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """words (word, n) -> a, n_a, b, n_b: all pairs exactly one edit apart, each once."""
    signed = park(signatures(words, parts), "signatures")
    short = signed.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.explode("own").alias("key"))
    side = lambda keys, longer: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(longer).alias("longer")))
    other = signed.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.inline(F.concat(side("own", False), side("less", True))))
    fits = F.when(F.col("longer"), F.length("b") == F.length("a") + 1).otherwise((F.length("b") == F.length("a")) & (F.col("a") < F.col("b")))
    found = short.join(other, "key").where(fits & (F.levenshtein("a", "b", 1) == 1))
    found = park(found.select("a", "n_a", "b", "n_b").distinct(), "near")
    unpark(words.sparkSession, signed)
    return found


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form) -> word, root: the last of the word's forms. Each round doubles the steps taken."""
    spark = forms.sparkSession
    at = park(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = park(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        unpark(spark, at)
        at = after
        if not at.agg(F.bool_or("moved").alias("moved")).first()["moved"]:
            return at.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, parts: int = PARTS, **params) -> DataFrame:
    """Per word: word, n, n_near (words one edit apart), form (the most frequent of them, if at least `ratio` times as frequent), form_n, root."""
    words = park(counts(docs, id_col, text_col, **params), "words")
    pairs = near_pairs(words, parts)
    ends = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("near")).alias("x")), F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("near")).alias("x")))))
    best = ends.groupBy("word").agg(F.count("*").alias("n_near"), F.min("x").alias("x"))
    frequent = -F.col("x.n") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(frequent, F.col("x.near")).alias("form"), F.when(frequent, -F.col("x.n")).alias("form_n"))
    formed = park(formed, "forms")
    unpark(docs.sparkSession, words, pairs)
    return formed.join(roots(formed.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
