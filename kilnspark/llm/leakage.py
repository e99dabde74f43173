"""Evaluation passages inside training text: size-partitioned MinHash containment search, then exact shingle containment.

Items fall into classes by their number of shingles, doubling from class to class. For each class documents are cut into
half-overlapping windows of the class's own length, so a passage, or a piece of one, is a good part of some window however
long the document is. From the smallest piece that must be found follow the least Jaccard similarity and the number of
MinHash values that finds it with the wanted certainty. Candidates are then verified on the whole document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"\w+")
_DIGITS = re.compile(r"(\d)[.,\s](?=\d)")
_SIZE = 3  # words a shingle; passages may have single words changed, longer shingles would break at each
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words(text: str) -> list[str]:
    """Runs of letters and digits in lower case; marks and blanks inside numbers go (4,515 and 4 515 are 4515)."""
    return _WORD.findall(_DIGITS.sub(r"\1", text.lower().replace("_", " ")))


def passage(text: str) -> str:
    """An item without its closing question."""
    return re.sub(r"(?:^|(?<=[.!?])\s+|\n)[^.!?\n]*\?\s*$", "", text.strip())


class _Hashes(dict):
    """word -> 64-bit hash, filled on demand."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Hasher:
    """64-bit hashes of words and of runs of three words."""

    def __init__(self) -> None:
        self.seen = _Hashes()

    def words(self, ws: list[str]) -> np.ndarray:
        if len(self.seen) > 500_000:
            self.seen.clear()
        return np.fromiter(map(self.seen.__getitem__, ws), np.uint64, len(ws))

    @staticmethod
    def shingles(h: np.ndarray) -> np.ndarray:
        """Hashes of the runs of words, empty for fewer than three."""
        if len(h) < _SIZE:
            return np.zeros(0, np.uint64)
        x = sum(h[i : len(h) - _SIZE + 1 + i] * _MIX[i] for i in range(_SIZE))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


@dataclass
class SizeClass:
    """The items of one size class: window length, MinHash factors, and the items' values, sorted for each factor."""

    window: int
    factors: np.ndarray
    values: list[np.ndarray] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)


@dataclass
class Index:
    ids: list
    shingles: list[np.ndarray]
    own: list[np.ndarray]
    classes: list[SizeClass]


def item_shingles(rows: list[tuple[object, str]]) -> tuple[list, list[np.ndarray]]:
    """The ids and distinct shingles of the (id, text) items that have any."""
    hasher, ids, sets = Hasher(), [], []
    for k, text in rows:
        s = np.unique(hasher.shingles(hasher.words(words(passage(text or "")))))
        if len(s):
            ids.append(k)
            sets.append(s)
    return ids, sets


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """The shingles that more than one item has."""
    every, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
    return every[count > 1]


def build_index(rows: list[tuple[object, str]], share: float = 1 / 3, pieces: int = 2, miss: float = 0.005, common: np.ndarray | None = None) -> Index:
    """Index over (id, text) items. A piece of ``share / pieces`` of an item is missed with a probability of at most ``miss``.

    ``common`` are the shingles of more than one item, where these rows are a block of more items; else they come from the rows.
    """
    ids, sets = item_shingles(rows)
    if not ids:
        return Index([], [], [], [])
    common = common_shingles(sets) if common is None else common
    own = [s[~np.isin(s, common)] for s in sets]
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        by_size.setdefault(len(s).bit_length(), []).append(i)
    rng, classes = np.random.default_rng(20260101), []
    for bits, members in sorted(by_size.items()):
        low, high = 1 << (bits - 1), (1 << bits) - 1
        window = max(8, low)
        piece = max(2, int(low * share / pieces))
        least = piece / (window + high - piece)
        n = math.ceil(math.log(miss) / math.log(1 - least))
        c = SizeClass(window, rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1))
        for f in c.factors:
            v = np.array([(sets[i].astype(np.uint32) * f).min() for i in members])
            order = np.argsort(v, kind="stable")
            c.values.append(v[order])
            c.items.append(np.array(members)[order])
        classes.append(c)
    return Index(ids, sets, own, classes)


def candidates(index: Index, sh: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of documents and items, pair by pair, that share a MinHash value in some window. ``sh`` holds the shingles of all documents in
    a row, ``ends`` where each ends."""
    found = [np.zeros(0, np.int64)]
    n = max(1, len(index.ids))
    begins = np.r_[0, ends[:-1]]
    low32 = sh.astype(np.uint32)
    for c in index.classes:
        half = max(1, c.window // 2)
        sizes = ends - begins
        blocks = -(-sizes // half)
        doc = np.repeat(np.arange(len(ends)), blocks)
        if not len(doc):
            continue
        first = np.repeat(begins - np.r_[0, np.cumsum(blocks)[:-1]] * half, blocks) + np.arange(len(doc)) * half
        last = np.repeat(ends, blocks) - 1
        block = low32[np.minimum(first + np.arange(half)[:, None], last)]  # half x blocks; a short block repeats its last shingle
        joined = np.flatnonzero(doc[:-1] == doc[1:])
        for f, values, items in zip(c.factors, c.values, c.items):
            low = (block * f).min(axis=0)
            if len(joined):
                low[joined] = np.minimum(low[joined], low[joined + 1])  # two blocks are a window
            at, to = np.searchsorted(values, low), np.searchsorted(values, low, side="right")
            hit = np.flatnonzero(at < to)
            if len(hit):
                many = to[hit] - at[hit]
                which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - at[hit], many)
                found.append(np.repeat(doc[hit], many) * n + items[which])
    pairs = np.unique(np.concatenate(found))
    return pairs // n, pairs % n


def shares(sets: list[np.ndarray], which: np.ndarray, docs: np.ndarray, sh: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    """For each pair (set ``which``, document ``docs``) the share of the set's shingles in the document; NaN for an empty set."""
    salt = lambda d: (d.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sizes = np.array([len(sets[i]) for i in which], np.int64)
    if not sizes.sum():
        return np.full(len(which), np.nan)
    inside = np.isin(np.concatenate([sets[i] for i in which]) ^ salt(np.repeat(docs, sizes)), sh ^ salt(doc_of))
    total = np.r_[0, np.cumsum(inside)]
    ends = np.cumsum(sizes)
    with np.errstate(invalid="ignore"):
        return (total[ends] - total[ends - sizes]) / sizes


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", contained: float = 0.2, distinctive: float = 0.17, block: int = 5000, chunk: int = 40_000) -> DataFrame:
    """(key, item_key, contained, distinctive): each document that holds a third or more of an item's passage, in one piece or two.

    A candidate is kept if the whole document holds at least ``contained`` of the item's shingles of three words and
    ``distinctive`` of those that no other item has; both lie below a third because changed words break the shingles around them.
    The closing question of an item doesn't count. NULL and empty texts hold nothing; items of fewer than three words are never
    found; a text delivered twice under one key is reported once; texts are searched whole.

    The items are the stated query set: they go to the executors in blocks of ``block`` items (about 100 bytes a shingle), each
    one pass over the documents without a shuffle; their number may grow. ``chunk`` bounds the shingles handled at once.
    """
    spark = docs.sparkSession
    rows = [(r[0], r[1]) for r in items.select(item_key, item_text).where(F.col(item_key).isNotNull()).dropDuplicates([item_key]).orderBy(item_key).toLocalIterator()]
    kind, ikind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    d = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("k IS NOT NULL AND length(t) > 0")
    common = common_shingles(item_shingles(rows)[1]) if len(rows) > block else None  # over all items, whatever their block
    out = None
    for start in range(0, max(1, len(rows)), block):
        index = spark.sparkContext.broadcast(build_index(rows[start : start + block], common=common))

        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            ix, hasher = index.value, Hasher()

            def search(keys: list, parts: list[np.ndarray]) -> list[tuple]:
                sh, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
                docs, items = candidates(ix, sh, ends)
                doc_of = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
                c = shares(ix.shingles, items, docs, sh, doc_of)
                keep = c >= contained
                docs, items, c = docs[keep], items[keep], c[keep]
                o = shares(ix.own, items, docs, sh, doc_of)
                o = np.where(np.isnan(o), c, o)
                return [(keys[n], ix.ids[i], float(x), float(y)) for n, i, x, y in zip(docs, items, c, o) if y >= distinctive]

            for b in batches:
                hits: list[tuple] = []
                keys, parts, size = [], [], 0
                for k, t in zip(b["k"], b["t"]):
                    p = hasher.shingles(hasher.words(words(t)))
                    if not len(p):
                        continue
                    keys.append(k), parts.append(p)
                    size += len(p)
                    if size >= chunk:
                        hits += search(keys, parts)
                        keys, parts, size = [], [], 0
                if parts:
                    hits += search(keys, parts)
                if hits:
                    yield pd.DataFrame(hits, columns=["k", "i", "contained", "distinctive"])

        part = d.mapInPandas(run, f"k {kind}, i {ikind}, contained double, distinctive double")
        out = part if out is None else out.unionAll(part)
    return out.groupBy("k", "i").agg(F.max("contained").alias("contained"), F.max("distinctive").alias("distinctive")).select(F.col("k").alias(key), F.col("i").alias(item_key), "contained", "distinctive")
