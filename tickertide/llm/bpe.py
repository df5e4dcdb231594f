"""Byte-level BPE, speculate and verify.

A greedy longest match proposes tokens for each word. A proposal is the true encoding exactly when no merge would
ever cross one of its token boundaries, so every adjacent pair is tested at once in numpy: both tokens are taken
apart in the reverse order of their making, and at each step the two pieces that touch are looked up among the
merges. Words with a failing pair are merged exactly with a heap.

Null text counts as empty: no tokens, and the digests of the empty string. Row order, ids and other columns are
untouched, repeated rows give repeated results, an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unicode White_Space, which the tokenizers library splits on; regex's own \s has four control characters more.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The published pre-tokenisation pattern of this vocabulary (a fixed value).
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+"
)
#: Words a worker remembers before it starts afresh.
CACHE_WORDS = 700_000
NEVER = np.int64(1) << 40
NEVER_RANK = int(NEVER)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class SpeculativeBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in t)
        self.id_of = {self.bytes_of[i]: i for i in vocab.values()}
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        #: The length of the longest token that starts with these two bytes.
        self.reach: dict[bytes, int] = {}
        for t in self.id_of:
            self.reach[t[:2]] = max(len(t), self.reach.get(t[:2], 1))
        self.text_of = [str(i) for i in range(size)]
        self.size = size
        # made[i]: the rank of the merge that makes token i, -1 for a byte; left and right: its two parts
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((x, y), (rank, z))
            if self.left[z] < 0:
                self.made[z], self.left[z], self.right[z] = rank, x, y
        self.rank_of = {p: r for p, (r, _) in self.merge.items()}
        self.made_by = {r: z for r, z in self.merge.values()}
        keys = np.array([x * size + y for x, y in self.merge], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([r for r, _ in self.merge.values()], np.int64)[order]
        done = self.left >= 0
        #: The boundary test needs parts that are made before their whole, and words must not skip the merges.
        self.sound = bool((self.made[done] > np.maximum(self.made[self.left[done]], self.made[self.right[done]])).all()) and not spec["model"].get("ignore_merges")
        self.cache: dict[str | int, tuple[int, ...]] = {}

    def greedy(self, word: bytes) -> list[int]:
        if (whole := self.id_of.get(word)) is not None:
            return [whole]
        out, at, n, get, reach = [], 0, len(word), self.id_of.get, self.reach.get
        while at < n:
            for end in range(min(n, at + reach(word[at : at + 2], 1)), at, -1):
                if (i := get(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of neighbours, whether no merge crosses the boundary between them."""
        ok = np.ones(len(a), bool)
        live, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        # the ranks of the merges that use up x and y; one that crosses comes first if it is lower, or equal and further left
        over_x, over_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            crosses = (rank < over_x) & (rank <= over_y) & (rank < NEVER)
            ok[live[crosses]] = False
            mx, my = self.made[x], self.made[y]
            go = ~crosses & ((mx >= 0) | (my >= 0))
            live, x, y, over_x, over_y, mx, my = (v[go] for v in (live, x, y, over_x, over_y, mx, my))
            undo_x = mx > my
            over_x, over_y = np.where(undo_x, mx, over_x), np.where(undo_x, over_y, my)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def exact(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        if len(ids) <= 48:
            return self.exact_short(ids)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(len(ids) - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[i], ids[j] = z, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                if m := self.merge.get((z, ids[k])):
                    heapq.heappush(heap, (m[0], i, z, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := self.merge.get((ids[h], z))):
                heapq.heappush(heap, (m[0], h, ids[h], z, m[1]))
        return [i for i in ids if i >= 0]

    def exact_short(self, ids: list[int]) -> list[int]:
        """The same by a scan for each merge, which is faster than a heap for short words."""
        get, made_by = self.rank_of.get, self.made_by
        found = [get(p, NEVER_RANK) for p in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best == NEVER_RANK:
                break
            i = found.index(best)
            ids[i : i + 2] = [made_by[best]]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), NEVER_RANK)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), NEVER_RANK)
        return ids

    def learn(self, words: list[str]) -> None:
        """Encode words that the cache lacks."""
        raw = [w.encode() for w in words]
        proposed = [self.greedy(w) for w in raw]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inner = owner[:-1] == owner[1:]
        good = np.full(len(words), self.sound) | (lengths <= 1) & (np.fromiter(map(len, raw), np.int64, len(raw)) <= 1)
        if self.sound and inner.any():
            keys, back = np.unique(flat[:-1][inner] * self.size + flat[1:][inner], return_inverse=True)
            fits = self.compatible(keys // self.size, keys % self.size)[back]
            good[owner[:-1][inner][~fits]] = False
        for w, b, ids, fine in zip(words, raw, proposed, good.tolist(), strict=True):
            self.cache[w] = tuple(ids if fine else self.exact(b))

    def pieces(self, text: str) -> list:
        """Words, and special tokens as their ids."""
        if self.split_special is None or not any(s in text for s in self.special):
            return WORDS.findall(text)
        out: list = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += WORDS.findall(part)
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        self.cache.update((i, (i,)) for i in self.special.values())
        get, known = self.cache.get, []
        for t in texts:
            known.append((words := self.pieces(t), found := list(map(get, words))))
            if None not in found:
                words.clear()
        if new := list({w for words, found in known if words for w, ids in zip(words, found, strict=True) if ids is None}):
            self.learn(new)
        for words, found in known:
            yield list(chain.from_iterable(map(get, words) if words else found))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def load(path: str) -> SpeculativeBPE:
    return SpeculativeBPE(path)


def blocks(texts: list[str], most: int = 1 << 21) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, so that a batch of long texts stays small."""
    block, n = [], 0
    for t in texts:
        if block and n + len(t) > most:
            yield block
            block, n = [], 0
        block.append(t)
        n += len(t)
    if block:
        yield block


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids (array), ids_sha256, decoded_sha256. with_ids=False leaves the array out."""

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, lists, sha, back = [], [], [], []
            for block in blocks(texts):
                for ids in bpe.encode_batch(block):
                    n.append(len(ids))
                    sha.append(hashlib.sha256(",".join(map(bpe.text_of.__getitem__, ids)).encode()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                    if with_ids:
                        lists.append(np.array(ids, np.int32))
            cols = {id_col: batch.column(0), "n_tokens": pa.array(n, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(cols | {"ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())})

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the text that the ids stand for; null ids give the empty text."""

    def run(batches):
        bpe = load(path)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "text": pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())})

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, text string")
