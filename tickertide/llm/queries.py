"""The registered queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.llm import bpe, chat, lines, mixing, neighbours, quality, secrets, sharding, simhash, suffixes, toxicity, trie, variants
from tickertide.llm.common import is_held_out, table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.spans(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda s: s["rank"] == 0)).cast("long").alias("n_assign"), F.size(F.filter("base", lambda s: s["rank"] == 1)).cast("long").alias("n_access"), F.size(F.filter("base", lambda s: s["rank"] == 2)).cast("long").alias("n_hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.concat("base", "added")).alias("spans"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    turns = chat.format_chats(chats, known=chats.where(~is_held_out(F.col("conv_id"))))
    return turns.select("conv_id", "turn", "role", F.col("found").alias("role_found"), F.length("rendered").cast("long").alias("n_rendered"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return dealt.select("doc_id", sharding.text_size(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_mix": op4_mix,
    "op5_suffixes": op5_suffixes,
    "op6_lines": op6_lines,
    "op7_neighbours": op7_neighbours,
    "op8_secrets": op8_secrets,
    "op9_simhash": op9_simhash,
    "op10_chat": op10_chat,
    "op11_variants": op11_variants,
    "op12_shards": op12_shards,
    "op13_prefix_trie": op13_prefix_trie,
}

#: crc32 by its table, which a rule makes: eight steps of the reversed polynomial.
_CRC = """steps AS (SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)"""

_TRIE = f"""WITH RECURSIVE {_CRC},
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, n, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(c AS varchar), ''), lambda x: cast(ascii(x) AS bigint))), lambda acc, b: xor(acc >> 8, t[cast(xor(acc, b) & 255 AS int) + 1])), 4294967295) % 9 AS h FROM (SELECT c, count(*) AS n FROM own GROUP BY 1), crc),
rebuilt AS (SELECT k.c, o.pos, o.said FROM convs k JOIN own o ON o.c = k.base AND o.pos < k.h UNION ALL SELECT o.c, o.pos - k.h + least(k.h, coalesce(b.n, 0)), o.said FROM own o JOIN convs k USING (c) LEFT JOIN convs b ON b.c = k.base WHERE o.pos >= k.h),
seqs AS (SELECT k.c, coalesce(s, []) AS s FROM convs k LEFT JOIN (SELECT c, list(said ORDER BY pos) AS s FROM rebuilt GROUP BY 1) USING (c)),
nodes AS (SELECT p, len(p) AS depth, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(cast(c AS varchar), ',' ORDER BY c) FILTER (WHERE n = len(p)), '')) AS ends_sha256 FROM (SELECT c, len(s) AS n, list_slice(s, 1, d) AS p FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM seqs)) GROUP BY 1),
kids AS (SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
under AS (SELECT n.p, cast(count(*) FILTER (WHERE k.n IS NULL) AS bigint) AS n_leaves, cast(sum(CASE WHEN x.depth > 0 THEN (x.n_convs - 1) * strlen(x.p[x.depth].text) ELSE 0 END) AS bigint) AS saved_tokens FROM nodes n JOIN nodes x ON x.depth >= n.depth AND list_slice(x.p, 1, n.depth) = n.p LEFT JOIN kids k ON k.p = x.p GROUP BY 1)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256 FROM nodes n JOIN under USING (p) LEFT JOIN kids USING (p) LEFT JOIN nodes q ON n.depth > 0 AND q.p = list_slice(n.p, 1, n.depth - 1)"""

#: The others cannot be written in SQL whole: they hash, learn, search, shuffle or tokenise. tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {"op13_prefix_trie": _TRIE}
