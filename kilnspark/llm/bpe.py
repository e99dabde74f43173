"""Byte-level BPE of a whole corpus in batched numpy merge rounds.

Words of a batch lie in one flat symbol array. Each round looks up the rank of all neighbouring pairs at once (binary search
over sorted pair keys), takes every word's lowest-ranked pair and merges all its places in the word. A round costs what the
unfinished words hold, so a few very long words don't slow the others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public tokenizers' files lie; a parameter everywhere.
TOKENIZERS = "/opt/tokenizers"

#: Fixed value: the pattern that cuts a text into words for this family of vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NONE = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes as themselves, others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Sorted pair keys with their ranks and merged ids. About 2 MB for 50,000 merges, whatever the corpus."""

    def __init__(self, first: np.ndarray, keys: np.ndarray, ranks: np.ndarray, ids: np.ndarray):
        self.first, self.keys, self.ranks, self.ids = first, keys, ranks, ids

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a tokenizer's JSON file with a vocabulary and a list of merges."""
        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        vocab, letters = model["vocab"], _byte_letters()
        first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            first[byte] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        ids = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        return cls(first, keys[order], np.arange(len(keys), dtype=np.int64)[order], ids[order])

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ``keys``, -1 where it is none."""
        want = left << 20 | right
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == want, at, -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(n), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            same = word[:-1] == word[1:]
            at = np.full(len(symbols), -1, np.int64)
            pairs = np.flatnonzero(same)
            at[pairs] = self.lookup(symbols[pairs], symbols[pairs + 1])
            rank = np.where(at >= 0, self.ranks[at], _NONE)
            starts = np.flatnonzero(np.r_[True, ~same])
            lowest = np.minimum.reduceat(rank, starts)
            of = np.repeat(lowest, np.diff(np.r_[starts, len(symbols)]))
            open_ = of < _NONE
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                symbols, word, at, rank, of = (x[open_] for x in (symbols, word, at, rank, of))
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == of)
            if len(hit) > 1:  # in a run of overlapping places, every second one
                new = np.r_[True, np.diff(hit) != 1]
                run = np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self.ids[at[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        word, ids = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)

    def encode(self, texts: list[str], pattern) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        number: dict[str, int] = {}
        sequence: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            found = pattern.findall(t)
            counts[i] = len(found)
            sequence.extend([number.setdefault(w, len(number)) for w in found])
        ids, sizes = self.encode_words([w.encode("utf-8", "surrogatepass") for w in number])
        begins = np.r_[0, np.cumsum(sizes)]
        seq = np.array(sequence, np.int64)
        own = sizes[seq]
        ends = np.cumsum(own)
        flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[seq] - (ends - own), own)
        upto = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
        return ids[flat], np.diff(upto)


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.json", batch_chars: int = 4_000_000) -> DataFrame:
    """(key, ids ARRAY<INT>): token ids of each text as stored, without special tokens.

    NULL and empty texts give an empty list; special tokens' strings are ordinary text. Every row is kept, repeated keys too;
    texts are encoded whole. ``batch_chars`` bounds the characters encoded at once and has no effect on the result. One scan,
    no shuffle; the vocabulary's tables go to the executors once, at a size fixed by the tokenizer.
    """
    import pyarrow as pa

    voc = docs.sparkSession.sparkContext.broadcast(_vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern, v = regex.compile(PATTERN), voc.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= batch_chars):
                    size += len(texts[end])
                    end += 1
                ids, sizes = v.encode(texts[at:end], pattern)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), lists], names=[key, "ids"])
                at = end

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
