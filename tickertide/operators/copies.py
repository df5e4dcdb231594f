"""Near copies: MinHash signatures in bands, hot buckets split by rare shingles, links verified on whole sets.

A text is the set of its n-word shingles, by 64-bit hashes. Its signature's BANDS bands of ROWS least hashes are its
buckets: two texts at 0.8 share none with a chance of 4 in 10,000. Texts of one set count as one from the start.

In each bucket all are first held against its least one, which joins a group of any size by as many links as it has
texts. What is left are texts outside the least one's group, of which a shared passage can bring very many together.
They are never paired all with all: each is dealt to its rarest shingles instead (a prefix of its set in order of
frequency, long enough that two similar sets share one of it), so that texts with nothing but a passage in common part
again, and no similar pair is lost by it. There, too, all are held against the least first. What remains is paired:
texts that share a shingle which is rare for both, without being alike.

Links are taken exactly, on whole sets, fetched only for texts that share a bucket. Null texts and texts without words
are one set. Rows without an id are left out, rows that share an id are as many texts. Ties go to the least id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest, xxh64_intdigest

from tickertide.functions.text import NON_WORD
from tickertide.operators.graph import components
from tickertide.sources.shared import park, unpark

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: Shingles hashed at once.
_SLICE = 8192


def shingle_hashes(text: str | None, n: int = WORDS) -> np.ndarray:
    """The distinct hashes of the n-word shingles, sorted; fewer words are one shingle, none none."""
    words = (text or "").encode().split()
    if not words:
        return np.empty(0, np.uint64)
    grams = {b" ".join(words)} if len(words) < n else {b" ".join(g) for g in zip(*(words[i:] for i in range(n)), strict=False)}
    return np.unique(np.fromiter((xxh64_intdigest(g) for g in grams), np.uint64, len(grams)))


class Signatures:
    """The bucket of a set in each band."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = random.integers(1 << 62, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = random.integers(1 << 62, size=bands * rows, dtype=np.uint64)

    def buckets(self, hashes: np.ndarray) -> list[int]:
        if not len(hashes):
            return []
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(hashes), _SLICE):
            np.minimum(least, (hashes[i : i + _SLICE, None] * self.factors + self.shifts).min(axis=0), out=least)
        return [xxh3_64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(least.reshape(self.bands, self.rows))]


def normal(text: Column) -> Column:
    """Words in lower case, a space between them."""
    return F.lower(F.regexp_replace(text, NON_WORD, " "))


def signed(docs: DataFrame, id_col: str, text: Column, n: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, whole (digest of the set), size, keys (buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Signatures(bands, rows)
        for batch in batches:
            sets = [shingle_hashes(t.as_py(), n) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([made.buckets(s) for s in sets], pa.list_(pa.int64()))], ["id", "whole", "size", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(run, f"id {kind}, whole binary, size long, keys array<long>")


def hashed(docs: DataFrame, id_col: str, text: Column, wanted: DataFrame, n: int = WORDS) -> DataFrame:
    """whole, hashes (the sorted set) of the sets in wanted (id, whole): their texts are read once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [shingle_hashes(t.as_py(), n).tobytes() for t in batch.column(0)]
            at = [i for i, (r, w) in enumerate(zip(raw, batch.column(1).to_pylist(), strict=True)) if xxh3_128_digest(r) == w]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at, pa.int64())), pa.array([raw[i] for i in at], pa.binary())], ["whole", "hashes"])

    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(wanted, "id").select("text", "whole")
    return texts.mapInArrow(run, "whole binary, hashes binary").dropDuplicates(["whole"])  # rows may share an id and a text


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """pairs (a, b) of digests -> those whose sets have the similarity (Jaccard)."""
    side = lambda k: sets.select(F.col("whole").alias(k), F.col("hashes").alias(f"h_{k}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = (np.frombuffer(h.as_buffer(), np.uint64) for h in (x, y))
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(both >= similarity * (len(u) + len(v) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "h_a", "h_b").mapInArrow(run, "a binary, b binary")


def _fits(similarity: float) -> Column:
    return F.least("size", "lead_size") >= F.greatest("size", "lead_size") * similarity - 1e-9


def _stars(members: DataFrame) -> DataFrame:
    """members (key, whole, size, root) -> the same with lead, lead_size and lead_root, of the key's least member; keys of one member go."""
    leads = members.groupBy("key").agg(F.min(F.struct("whole", "size", "root")).alias("l"), F.count("*").alias("n")).where("n > 1")
    return members.join(leads.select("key", F.col("l.whole").alias("lead"), F.col("l.size").alias("lead_size"), F.col("l.root").alias("lead_root")), "key")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members with root: their component's, or themselves."""
    return members.drop("root").join(roots, F.col("whole") == F.col("node"), "left").withColumn("root", F.coalesce("root", "whole")).drop("node")


def rare_keys(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """sets (whole, size, hashes) -> key, whole, size: each set at the shingles of its prefix in order of frequency, but for those that no other has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, size, raw in zip(*(batch.column(i) for i in range(3)), strict=True):
                h = np.frombuffer(raw.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([whole.as_py()] * len(h), pa.binary()), pa.array([size.as_py()] * len(h), pa.int64()), pa.array(h)], ["whole", "size", "key"])

    each = park(sets.select("whole", "size", "hashes").mapInArrow(run, "whole binary, size long, key long"), "shingles")
    common = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # shingles that no other set has come first in the order, and lead nowhere
    of_set = each.join(common, "key").groupBy("whole", "size").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("shared"))
    left = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1 - (F.col("size") - F.size("shared"))
    return of_set.select("whole", "size", F.explode(F.slice("shared", F.lit(1), F.greatest(left, F.lit(0)).cast("int"))).alias("s")).select("s.key", "whole", "size")


def near_links(distinct: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """distinct (whole, size, keys) of sets that share buckets -> links (a, b), enough to connect all that are similar."""
    spark = distinct.sparkSession
    members = park(_stars(distinct.select(F.explode("keys").alias("key"), "whole", "size").withColumn("root", F.col("whole"))), "members")
    pair = (F.col("whole").alias("a"), F.col("lead").alias("b"))
    first = park(verified(members.where((F.col("whole") != F.col("lead")) & _fits(similarity)).select(*pair), sets, similarity), "stars")
    roots = park(components(first), "roots")
    lead = roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    grouped = _rooted(members, roots).drop("lead_root").join(lead, "lead", "left").withColumn("lead_root", F.coalesce("lead_root", "lead"))
    # buckets in which some stand outside the least one's group
    open_keys = grouped.where("root <> lead_root").select("key").distinct()
    left = park(grouped.join(open_keys, "key", "left_semi").select("whole").distinct(), "left")
    rare = _rooted(rare_keys(sets.join(left, "whole").withColumn("size", F.expr("octet_length(hashes) div 8")), similarity), roots)
    rare = park(_stars(rare), "rare")
    second = park(verified(rare.where((F.col("root") != F.col("lead_root")) & _fits(similarity)).select(*pair), sets, similarity), "stars")
    linked = first.unionByName(second)
    roots2 = park(components(linked), "roots")
    lead = roots2.select(F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    again = _rooted(rare.select("key", "whole", "size", "lead"), roots2).join(lead, "lead", "left")
    again = park(again.select("key", "whole", "size", "root", (F.col("root") != F.coalesce("lead_root", "lead")).alias("out")), "again")
    other = again.select("key", F.col("whole").alias("lead"), F.col("size").alias("lead_size"), F.col("root").alias("lead_root"), F.col("out").alias("lead_out"))
    # each pair once: by order where both stand outside
    rest = again.where("out").join(other, "key").where((~F.col("lead_out") | (F.col("whole") < F.col("lead"))) & (F.col("root") != F.col("lead_root")) & _fits(similarity))
    third = park(verified(rest.select(*pair), sets, similarity), "rest")
    links = park(linked.unionByName(third), "links")
    unpark(spark, members, first, roots, left, rare, second, roots2, again, third)
    return links


def similar(docs: DataFrame, id_col: str, text: Column, n: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs' ids (as id) with group_id: the least id among the texts that links reach. text: words with white space between them."""
    spark = docs.sparkSession
    every = park(signed(docs, id_col, text, n, bands, rows), "signed")
    distinct = park(every.groupBy("whole").agg(F.min("id").alias("least"), F.first("size").alias("size"), F.first("keys").alias("keys")), "distinct")
    busy = distinct.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    met = park(distinct.select("whole", F.explode("keys").alias("key")).join(busy, "key").select("whole").distinct(), "met")
    near = distinct.join(met, "whole")
    sets = park(hashed(docs, id_col, text, near.select(F.col("least").alias("id"), "whole"), n), "sets")
    roots = components(near_links(near.select("whole", "size", "keys"), sets, similarity))
    group = park(_rooted(distinct.select("whole", "least"), roots), "group")
    least = park(group.groupBy("root").agg(F.min("least").alias("group_id")), "least")
    out = park(every.select("id", "whole").join(group.join(least, "root").select("whole", "group_id"), "whole").select("id", "group_id"), "similar")
    unpark(spark, every, distinct, met, sets, group, least)
    return out


def near_copies(docs: DataFrame, id_col: str, text: Column, n: int = WORDS, similarity: float = SIMILARITY, **params) -> DataFrame:
    """id, group_id, n_group (its texts) of texts that have a near copy; case, punctuation and spacing do not count."""
    found = similar(docs, id_col, normal(text), n, similarity, **params)
    sizes = found.groupBy("group_id").agg(F.count("*").alias("n_group")).where("n_group > 1")
    return found.join(sizes, "group_id").select(F.col("id").alias(id_col), "group_id", "n_group")
