"""The prefix trie of conversations, its subtree totals by parallel tree contraction.

A turn is known by two 64-bit hashes of its role and text, and a prefix by the exclusive-or of its turns' hashes, each
mixed with its place: so a prefix's key is a running bit_xor, and a conversation of any length is cut into stretches
whose totals are carried on. A node is known by its least member and its depth.

Totals: each round first rakes the leaves (a leaf hands its total to its parent), then compresses chains (a node with
one child goes, and its child is hung on its parent by an edge that carries what the node had). A node goes in round r
if bit r of its depth is set and that of its parent is not, so no two neighbours go at once, and a chain halves in each
round. A node holds its number of children and the exclusive-or of their keys, which with one child left is that
child's key: each half round is one grouping of messages and one join by unique keys, and no node's children are
ever gathered. Re-expansion walks the rounds back: what was compressed in a round gets its total from the one child it
had then. Every round is written to the shared folder; a lost executor costs one round at most.

Null roles and texts count as empty, rows without a conversation id are left out, and null turns come first. Turns of
equal number follow each other by a hash of role and text, repeated rows stay. Texts may have any length. Other columns,
whatever their names, are not looked at. An empty table has no conversations and so no nodes, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import park, unpark

#: rebuilt(): conversations of a family, and the turns that a member takes from its first one are fewer than this.
FAMILY, TAKEN = 5, 9
#: Bytes of ids that go into a digest at once.
CHUNK = 1 << 20
NODE = ["conv_id", "depth"]


def turns(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """c, part, pos (from 0, in order of turns), h1, h2, size: c's turns, numbered by a sort over all rows, so no conversation is held by one task."""
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    said = (empty(role_col), empty(text_col))
    rows = chats.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.xxhash64(*said).alias("h1"), F.xxhash64(F.lit("turn"), *said).alias("h2"), F.octet_length(said[1]).cast("long").alias("size"))
    rows = park(rows, "turns")
    # Spark sorts nulls first
    dealt = rows.repartitionByRange("c", "turn", "h1", "h2").sortWithinPartitions("c", "turn", "h1", "h2").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = park(dealt.drop("turn"), "dealt")
    spans = dealt.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("c", "part", (before - F.col("first")).alias("shift"))
    numbered = park(dealt.join(spans, ["c", "part"]).select("c", "part", (F.col("at") + F.col("shift")).alias("pos"), "h1", "h2", "size"), "numbered")
    unpark(chats.sparkSession, rows, dealt)
    return numbered


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns() -> the same with the first h turns of the family's first conversation in place of c's own first h, and all c.
    h is crc32 of c's decimal text, mod TAKEN; the family's first is c - c mod FAMILY."""
    convs = own.groupBy("c").agg(F.count("*").alias("n"))
    convs = park(convs.select("c", "n", (F.col("c") - F.pmod("c", F.lit(FAMILY))).alias("base"), F.pmod(F.crc32(F.col("c").cast("string")), F.lit(TAKEN)).alias("h")), "convs")
    firsts = convs.select(F.col("c").alias("base"), F.col("n").alias("there"))
    convs = park(convs.join(firsts, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "families")
    # TAKEN - 1 rows of a conversation at most
    head = own.where(F.col("pos") < TAKEN - 1).select(F.col("c").alias("base"), "pos", "h1", "h2", "size")
    head = convs.select("c", "base", "h").join(head, "base").where("pos < h").select("c", F.lit(-1).alias("part"), "pos", "h1", "h2", "size")
    tail = own.join(convs.select("c", "h", "taken"), "c").where("pos >= h").select("c", "part", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "size")
    return park(head.unionByName(tail), "rebuilt"), convs.select("c")


def tags() -> list[Column]:
    """A turn's hashes, mixed with its place."""
    return [F.xxhash64("pos", "h1").alias("t1"), F.xxhash64("h2", "pos").alias("t2")]


def prefixes(rows: DataFrame) -> DataFrame:
    """rows (c, part, pos, h1, h2, size) -> c, depth, d1, d2 (the key of the prefix that ends here), p1, p2 (of the one before), size."""
    tagged = rows.select("c", "part", "pos", "size", *tags())
    along = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("c", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = tagged.groupBy("c", "part").agg(*(F.bit_xor(t).alias(t) for t in ("t1", "t2")))
    carried = carried.select("c", "part", *(F.coalesce(F.bit_xor(t).over(along), F.lit(0).cast("long")).alias(f"c{t[1]}") for t in ("t1", "t2")))
    run = tagged.withColumns({f"r{k}": F.bit_xor(f"t{k}").over(within) for k in (1, 2)}).join(carried, ["c", "part"])
    keys = {f"d{k}": F.col(f"r{k}").bitwiseXOR(F.col(f"c{k}")) for k in (1, 2)}
    run = run.withColumns(keys)
    return run.select("c", (F.col("pos") + 1).alias("depth"), "d1", "d2", *(F.col(f"d{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2)), "size")


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """depth, d1, d2, c: where each conversation ends."""
    zero = F.lit(0).cast("long")
    last = rows.select("c", *tags()).groupBy("c").agg(F.count("*").alias("depth"), F.bit_xor("t1").alias("d1"), F.bit_xor("t2").alias("d2"))
    return convs.join(last, "c", "left").select(*(F.coalesce(k, zero).alias(k) for k in ("depth", "d1", "d2")), "c")


def digests(ends: DataFrame) -> DataFrame:
    """ends (depth, d1, d2, c) -> depth, d1, d2, ends_sha256: of the ids in order, joined by commas.

    Ids are put in order by a sort over all rows, which cuts a node's ids anywhere, and written out in chunks of
    CHUNK bytes; then the chunks of a node go by in order, one at a time.
    """
    key = ["depth", "d1", "d2"]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, 0, [], 0
        done: list[tuple] = []
        for batch in batches:
            for *at, c in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if at != node or size >= CHUNK:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    node, first, ids, size = at, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield from _batch(done, chunked)
            done = []
        yield from _batch([(*node, first, ",".join(ids))] if ids else [], chunked)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, so_far = None, None
        for batch in batches:
            done = []
            for *at, _, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if at != node:
                    if node:
                        done.append((*node, so_far.hexdigest()))
                    node, so_far = at, sha256(text.encode())
                else:
                    so_far.update(b"," + text.encode())
            yield from _batch(done, named)
        yield from _batch([(*node, so_far.hexdigest())] if node else [], named)

    chunked = pa.schema([*((k, pa.int64()) for k in (*key, "first")), ("ids", pa.string())])
    named = pa.schema([*((k, pa.int64()) for k in key), ("ends_sha256", pa.string())])
    chunks = ends.repartitionByRange(*key, "c").sortWithinPartitions(*key, "c").mapInArrow(written, "depth long, d1 long, d2 long, first long, ids string")
    return chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hashed, "depth long, d1 long, d2 long, ends_sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# contraction


def _zero(column: Column | str) -> Column:
    return F.coalesce(column, F.lit(0).cast("long"))


def rake(live: DataFrame, sums: list[str]) -> DataFrame:
    """Without the leaves; each parent has their totals and one child less for each."""
    leaf = (F.col("k") == 0) & F.col("p_conv").isNotNull()
    said = live.where(leaf).groupBy(F.col("p_conv").alias("to_conv"), F.col("p_depth").alias("to_depth"))
    said = said.agg(F.count("*").alias("n"), F.bit_xor("conv_id").alias("u"), F.bit_xor("depth").alias("v"), *(F.sum(F.col(s) + F.col(f"on_{s}")).alias(f"add_{s}") for s in sums))
    told = live.where(~leaf).join(said, (F.col("conv_id") == F.col("to_conv")) & (F.col("depth") == F.col("to_depth")), "left")
    new = {"k": F.col("k") - _zero("n"), "x_conv": F.col("x_conv").bitwiseXOR(_zero("u")), "x_depth": F.col("x_depth").bitwiseXOR(_zero("v"))} | {s: F.col(s) + _zero(f"add_{s}") for s in sums}
    return told.withColumns(new).select(*live.columns)


def compress(live: DataFrame, bit: int, sums: list[str]) -> DataFrame:
    """Without the chain nodes of this round. Their children have new parents, and columns was_conv, was_depth and was_<sum>
    tell which node went and what its total has beside the child's."""
    on = lambda depth: F.shiftright(depth, bit).bitwiseAND(F.lit(1)) == 1
    goes = F.coalesce((F.col("k") == 1) & on(F.col("depth")) & ~on(F.col("p_depth")), F.lit(False))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    to = lambda conv, depth, up, turned, kept: F.struct(conv.alias("to_conv"), depth.alias("to_depth"), up[0].alias("up_conv"), up[1].alias("up_depth"), turned[0].alias("u"), turned[1].alias("v"), *((F.col(s) if kept else zero).alias(f"m_{s}") for s in (*sums, *(f"on_{s}" for s in sums))))
    down = to(F.col("x_conv"), F.col("x_depth"), (F.col("p_conv"), F.col("p_depth")), (zero, zero), True)
    # in the parent's key of children, the child stands for the node that goes
    up = to(F.col("p_conv"), F.col("p_depth"), (none, none), (F.col("conv_id").bitwiseXOR(F.col("x_conv")), F.col("depth").bitwiseXOR(F.col("x_depth"))), False)
    said = live.where(goes).select(F.inline(F.array(down, up))).groupBy("to_conv", "to_depth")
    said = said.agg(F.max("up_conv").alias("up_conv"), F.max("up_depth").alias("up_depth"), F.bit_xor("u").alias("u"), F.bit_xor("v").alias("v"), *(F.sum(f"m_{s}").alias(f"m_{s}") for s in (*sums, *(f"on_{s}" for s in sums))))
    told = live.where(~goes).join(said, (F.col("conv_id") == F.col("to_conv")) & (F.col("depth") == F.col("to_depth")), "left")
    hung = F.col("up_depth").isNotNull()
    was = {"was_conv": F.when(hung, F.col("p_conv")), "was_depth": F.when(hung, F.col("p_depth"))} | {f"was_{s}": F.when(hung, F.col(f"on_{s}") + F.col(f"m_{s}")) for s in sums}
    new = {"p_conv": F.coalesce("up_conv", "p_conv"), "p_depth": F.coalesce("up_depth", "p_depth"), "x_conv": F.col("x_conv").bitwiseXOR(_zero("u")), "x_depth": F.col("x_depth").bitwiseXOR(_zero("v"))}
    new |= {f"on_{s}": F.col(f"on_{s}") + _zero(f"m_{s}") + _zero(f"m_on_{s}") for s in sums}
    return told.withColumns(was | new).select(*live.columns, *was)


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """nodes (conv_id, depth, p_conv, p_depth (null at the root), k children, the exclusive-or x_conv and x_depth of their
    keys, and columns sums) -> conv_id, depth, and the sums over each node's subtree."""
    spark = nodes.sparkSession
    own = ["conv_id", "depth", "p_conv", "p_depth", "k", "x_conv", "x_depth", *sums, *(f"on_{s}" for s in sums)]
    live = park(nodes.withColumns({f"on_{s}": F.lit(0).cast("long") for s in sums}).select(*own), "live")
    deepest = live.agg(F.max("depth").alias("d")).first()["d"] or 0
    rounds: list[tuple[DataFrame, int]] = [(live, 0)]
    left = live.count()
    while left > 1:
        bit = (len(rounds) - 1) % max(1, int(deepest).bit_length())
        live = park(compress(rake(live.select(*own), sums), bit, sums), "live")
        counts = live.agg(F.count("*").alias("left"), F.count("was_depth").alias("gone")).first()
        left = counts["left"]
        rounds.append((live, counts["gone"]))
    known: DataFrame | None = None
    opened = []
    for live, gone in reversed(rounds):
        # leaves of this round, and the root at the end: nothing is missing from their totals
        whole = live.where("k = 0").select("conv_id", "depth", *sums)
        known = whole if known is None else known.unionByName(whole)
        if gone:
            went = live.where("was_depth is not null").select("conv_id", "depth", *(f"was_{c}" for c in ("conv", "depth", *sums)))
            found = went.join(known, NODE).select(F.col("was_conv").alias("conv_id"), F.col("was_depth").alias("depth"), *((F.col(s) + F.col(f"was_{s}")).alias(s) for s in sums))
            opened.append(park(found, "opened"))
            known = known.unionByName(opened[-1])
    done = park(known, "totals")
    unpark(spark, *(r[0] for r in rounds), *opened)
    return done


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """rows (c, part, pos, h1, h2, size: turns in order) and all c -> a row for each node: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    key = ["depth", "d1", "d2"]
    top = convs.agg(F.min("c").alias("c"), F.count("*").alias("n")).first()
    zero, first = F.lit(0).cast("long"), F.lit(top["c"]).cast("long")
    nodes = prefixes(rows).groupBy(*key).agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = park(nodes, "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("p_conv"))
    root = spark.range(1 if top["n"] else 0).select(*(zero.alias(k) for k in key), first.alias("conv_id"), F.lit(top["n"]).alias("n_convs"), zero.alias("size"), F.lit(None).cast("long").alias("p_conv"))
    rest = nodes.join(above, ["depth", "p1", "p2"]).select(*root.columns)
    # nodes of depth 1 may be very many, and all have the root for parent
    every = park(root.unionByName(nodes.where("depth = 1").withColumn("p_conv", first).select(*root.columns)).unionByName(rest).withColumn("p_depth", F.when(F.col("p_conv").isNotNull(), F.col("depth") - 1)), "nodes")
    kids = every.where("p_conv is not null").groupBy(F.col("p_conv").alias("conv_id"), F.col("p_depth").alias("depth")).agg(F.count("*").alias("k"), F.bit_xor("conv_id").alias("x_conv"), F.bit_xor("depth").alias("x_depth"))
    every_kid = every.join(kids, NODE, "left").withColumns({c: _zero(c) for c in ("k", "x_conv", "x_depth")})
    table = park(every_kid.withColumns({"n_leaves": F.when(F.col("k") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")}), "table")
    unpark(spark, nodes, every)
    totals = subtree_totals(table, ["n_leaves", "saved_tokens"])
    ended = park(digests(park(ends(rows, convs), "ends")), "digests")
    out = table.drop("n_leaves", "saved_tokens").join(totals, NODE).join(ended, key, "left")
    out = out.select(*NODE, F.col("p_conv").alias("parent_conv_id"), "n_convs", F.col("k").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    return out


def prefix_trie(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", rebuild: bool = True) -> DataFrame:
    """The trie of chats' conversations, rebuilt by families or as they are."""
    own = turns(chats, conv_col, turn_col, role_col, text_col)
    rows, convs = rebuilt(own) if rebuild else (own, own.select("c").distinct())
    return trie(rows, convs)
