"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has 64 bits; a bit is set if more than half of the text's 3-word shingles have it in their XXH64
(seed 42). Distinct fingerprints are dealt into cells by the population counts of their four quarters. Flipping one
bit moves one count by one, so two fingerprints within the radius lie in cells whose counts differ by no more than
the radius in sum: other pairs of tiles are never formed. Tiles of the remaining pairs are compared whole, with numpy
exclusive-or and bit counts, and each pair of tiles gives a spanning forest of its links, so that thousands of
copies never turn into all their pairs. Links lose nothing: components over the forests are those over all links.

Null text counts as empty; a text without words has fingerprint 0 and links like any other. Texts may have any length:
one is held at a time. Repeated rows keep their rows, ties go to the smaller id; a null id never becomes a component's
id unless no other is there. Other columns, whatever their names, are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickertide.llm.common import packed, park, unpark
from tickertide.llm.graph import components
from tickertide.operators import copies

SEED, SHINGLE, RADIUS = 42, 3, 2
#: similar() and keep_one(): words of a shingle and the similarity of the sets.
WORDS, SIMILARITY = 5, 0.8
#: Fingerprints in a tile, about: a pair of tiles takes a few MB in slices.
TILE = 2048
_SLICE = 512


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(n)), strict=False)]
    h = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8").view(np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(h[i : i + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for i in range(0, len(h), 65536))
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """Per row: the id and fp, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "fp": pa.array([fingerprint(t.as_py(), n) for t in batch.column(1)], pa.int64())})

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp long")


def _count(fp: Column, quarter: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, 16 * quarter).bitwiseAND(F.lit(0xFFFF)))


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Half of the moves between cells that differ by no more than the radius in sum; the other half mirrors it."""
    return sorted(m for m in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, m)) <= radius and m >= (0, 0, 0, 0))


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between two tiles."""
    near = np.concatenate([np.bitwise_count(a[i : i + _SLICE, None] ^ b[None, :]) <= radius for i in range(0, len(a), _SLICE)])
    i, j = np.nonzero(near)
    far = a[i] != b[j]
    nodes, at = np.unique(np.concatenate([a[i[far]], b[j[far]]]), return_inverse=True)
    x, y = np.split(at, 2)
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = least[least]
        if (least == label).all():
            break
        label = least
    own = np.arange(len(nodes)) != label
    return nodes[own], nodes[label[own]]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """fps (fp, distinct) -> edges (a, b) that connect what is within the radius, and nothing else."""
    counts = [_count(F.col("fp"), k).alias(f"c{k}") for k in range(4)]
    celled = fps.select("fp", *counts).withColumn("cell", F.expr("c0 + 17 * (c1 + 17 * (c2 + 17 * c3))"))
    many = celled.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("n"))  # 17^4 cells at most
    tiles = celled.join(many, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("n")))
    tiles = tiles.groupBy("cell", "tile").agg(*(F.first(f"c{k}").alias(f"c{k}") for k in range(4)), F.collect_list("fp").alias("fps"))
    tiles = park(tiles, "tiles")
    moves = F.array(*(F.struct(*(F.lit(d).alias(f"d{k}") for k, d in enumerate(m))) for m in _steps(radius)))
    moved = [F.col(f"c{k}") + F.col(f"m.d{k}") for k in range(4)]
    inside = " and ".join(f"c{k} + m.d{k} between 0 and 16" for k in range(4))
    other = tiles.select("*", F.explode(moves).alias("m")).where(inside).select((moved[0] + 17 * (moved[1] + 17 * (moved[2] + 17 * moved[3]))).alias("cell"), F.col("cell").alias("cell_b"), F.col("tile").alias("tile_b"), F.col("fps").alias("fps_b"))
    pairs = tiles.select("cell", "tile", "fps").join(other, "cell").where("cell <> cell_b or tile <= tile_b").select("fps", "fps_b")

    def run(batches):
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a, b = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
                u, v = _forest(a, b, radius)
                yield pa.RecordBatch.from_pydict({"a": pa.array(u.view(np.int64), pa.int64()), "b": pa.array(v.view(np.int64), pa.int64())})

    return pairs.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: id, fp, component_id (the least id that links reach)."""
    fps = park(fingerprints(docs, id_col, text_col, n), "fps")
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(links(distinct.select("fp"), radius))
    group = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = group.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(group.join(least, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Per id: component_id (the least id that links reach).

    Fingerprints in tiles link what is nearly the same. Texts at the similarity of their n-word shingles may differ by a
    dozen bits, though, a radius at which population counts tell no tiles apart. So the join of whole shingle sets, whose
    buckets are bounded and whose links are exact, adds what is similar; components are those over both kinds of links.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tiled = near_duplicates(rows, "id", "text").select("id", F.col("component_id").alias("to"))
    joined = copies.similar(rows, "id", F.lower("text"), n, similarity).select("id", F.col("group_id").alias("to"))
    linked = park(tiled.unionByName(joined).distinct(), "joined")
    roots = components(linked.select(F.col("id").alias("a"), F.col("to").alias("b")))
    out = park(linked.select("id").distinct().join(roots, F.col("id") == F.col("node"), "left").select(F.col("id").alias(id_col), F.coalesce("root", "id").alias("component_id")), "similar")
    unpark(spark, linked)
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each component of similar(), that of the least id. Rows without an id stay, and so do all
    rows that share the kept id; columns may have any names."""
    kept = similar(docs, id_col, text_col, n, similarity).where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("kept"))
    own = F.col("packed")[id_col]
    return packed(docs).join(kept, own == F.col("kept"), "left").where(F.col("kept").isNotNull() | own.isNull()).select("packed.*")
