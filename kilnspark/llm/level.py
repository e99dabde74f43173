"""Reading level of documents: smoothed unigram language models per level, highest posterior.

The models are trained on graded passages, then refined on the passages' own sentences, because a graded passage may hold
sentences of other levels. Each sentence of a document gets the level with the highest posterior likelihood, and the document the
level of most of its sentences. Where sentences are run together without marks, a stretch counts as as many sentences as its
words make at the usual length of a sentence of its level.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|[;\n\r]+|(?<=[!?])(?=[A-Z])|(?:^|(?<=\s))[QA]:\s")
#: Abbreviations whose full stop ends no sentence.
_SHORT = re.compile(r"\b(?:e\.\s?g|i\.\s?e|a\.m|p\.m|cf|approx|fig|figs|eq|ref|vs|etc|no|dr|ca)\.", re.I)
_TITLE = re.compile(r"\A\s*([^\n\r.!?]{1,80})\r?\n\s*\r?\n")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")

#: Frequent function words, by which running prose of a language is known.
FUNCTION_WORDS = {
    "en": "the of and to in is was that it for on with as by at from this are be have has had not or which when after before will they their there its an than were who you we can if but all more no so",
    "de": "der die das und ist von den mit zu ein eine im auf für nicht wird werden sich des dem auch als nach bei aus wurde wurden oder wie bis einer durch je desto ob",
    "fr": "le la les de des et est du un une dans pour que qui sur pas plus par avec au sont ce se aux être ou où après selon en ont",
    "es": "el la los las de y en que un una por con para del se no más es al lo como su según tras fue hubo durante",
}
_LISTS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}


def is_english_prose(ws: list[str], text: str, known: dict[str, int], least: float = 0.12) -> bool:
    """Whether the words (lower case) are English running prose.

    English: enough English function words, or some and mostly words ``known`` from the graded passages (dense nominal style has
    few function words); and clearly more function words than of any other language. Texts of table cells or numbers are no prose.
    """
    if not ws:
        return False
    count = Counter(ws)
    n = {k: sum(count[w] for w in words if w in count) for k, words in _LISTS.items()}
    if n["en"] <= 1.5 * max(v for k, v in n.items() if k != "en"):
        return False
    if n["en"] < least * len(ws) and (n["en"] < 0.04 * len(ws) or sum(c for w, c in count.items() if w in known) < 0.6 * len(ws)):
        return False
    return text.count("|") * 20 < len(ws) and len(_NUMBER.findall(text)) * 4 < len(ws)


@dataclass
class Model:
    levels: list[int]
    number: dict[str, int]
    logp: np.ndarray  # words x levels; the last row is for unseen words
    prior: np.ndarray
    length: np.ndarray  # usual words in a sentence of the level

    def scores(self, ws: list[str]) -> np.ndarray:
        get, unseen = self.number.get, len(self.logp) - 1
        return self.logp[[get(w, unseen) for w in ws]].sum(axis=0) + self.prior

    def level(self, text: str) -> int | None:
        """The level of most sentences; None for a text without words. Ties go to the lower level."""
        get, unseen = self.number.get, len(self.logp) - 1
        ids: list[int] = []
        starts: list[int] = []
        for s in sentences(text):
            ws = [get(w, unseen) for w in _WORD.findall(s.lower())]
            if len(ws) >= 3:
                starts.append(len(ids))
                ids += ws
        if not ids:
            return None
        x = self.logp[ids]
        best = np.argmax(np.add.reduceat(x, starts) + self.prior, axis=1)
        sizes = np.diff([*starts, len(ids)])
        total = np.zeros(len(self.levels))
        for at, size, k in zip(starts, sizes, best):
            if size > 2 * self.length[k]:  # perhaps several sentences, perhaps of several levels
                for n, j in pieces(x[at : at + size], self.prior):
                    total[j] += n / self.length[j]
            else:
                total[k] += 1
        return self.levels[int(np.argmax(np.round(total, 6)))]


def sentences(text: str) -> list[str]:
    """The sentences of a text, without a title line on top."""
    text = _SHORT.sub(lambda m: m[0].replace(".", ""), _TITLE.sub("", text))
    return [s for s in _SENTENCE.split(text) if s]


def pieces(x: np.ndarray, prior: np.ndarray, change: float = 12.0) -> list[tuple[int, int]]:
    """(words, level) of the stretches of one level in a run of words with scores ``x``: the likeliest way, a change of level
    costing ``change``."""
    rows = x.tolist()
    best = [a + b for a, b in zip(rows[0], prior.tolist())]
    own, back = range(len(best)), []
    for row in rows[1:]:
        high = max(best)
        top, floor = best.index(high), high - change
        back.append([k if best[k] >= floor else top for k in own])
        best = [(v if v >= floor else floor) + r for v, r in zip(best, row)]
    k, out = best.index(max(best)), []
    for i in range(len(rows) - 1, -1, -1):
        if out and out[-1][1] == k:
            out[-1] = (out[-1][0] + 1, k)
        else:
            out.append((1, k))
        if i:
            k = back[i - 1][k]
    return out


def train(rows: list[tuple[str, int]], smoothing: float = 0.1, rounds: int = 3) -> Model:
    """A model from (text, level) rows: counts of words per level, then ``rounds`` times again with every sentence moved to the
    level that the model gives it."""
    levels = sorted({k for _, k in rows})
    at = {k: i for i, k in enumerate(levels)}
    parts = [(ws, at[k]) for t, k in rows for s in sentences(t) if len(ws := _WORD.findall(s.lower())) >= 3]
    number: dict[str, int] = {}
    for ws, _ in parts:
        for w in ws:
            number.setdefault(w, len(number))
    model = None
    for _ in range(rounds + 1):
        counts, lengths = np.full((len(number) + 1, len(levels)), smoothing), [[] for _ in levels]
        for ws, k in parts:
            if model is not None:
                s = model.scores(ws)
                s[k] += 2.0  # the grade speaks for its own level
                k = int(np.argmax(s))
            np.add.at(counts[:, k], [number[w] for w in ws], 1)
            lengths[k].append(len(ws))
        logp = np.log(counts / counts.sum(axis=0))
        model = Model(levels, number, logp, np.zeros(len(levels)), np.array([float(np.median(x)) if x else 15.0 for x in lengths]))
    return model


def reading_levels(docs: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text", sample_text: str = "text", sample_level: str = "level_no", least_words: int = 70, max_samples: int = 20_000) -> DataFrame:
    """(key, level_no): the reading level of each document of English running prose with ``least_words`` words or more.

    Words are runs of letters; the language is told by the text. NULL and empty texts, other languages and data sheets give no
    row; a document delivered twice under one key gives one row. Ties go to the lower level. Whole texts are read. The models are trained on at
    most ``max_samples`` graded passages (those of the smallest texts' hash), so they have a bounded size; without any passage there is no row.
    One scan without a shuffle before the last aggregation on the key.
    """
    spark = docs.sparkSession
    rows = samples.where(F.col(sample_text).isNotNull() & F.col(sample_level).isNotNull()).select(sample_text, F.col(sample_level).cast("int")).orderBy(F.xxhash64(sample_text)).limit(max_samples).collect()
    kind = docs.schema[key].dataType.simpleString()
    d = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("k IS NOT NULL AND length(t) > 0")
    if not rows:
        return d.where("false").selectExpr("k", "0 AS level_no").withColumnRenamed("k", key)
    model = spark.sparkContext.broadcast(train([(r[0], r[1]) for r in rows]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            out = []
            for k, t in zip(b["k"], b["t"]):
                ws = _WORD.findall(t.lower())
                if len(ws) >= least_words and is_english_prose(ws, t, m.number) and (level := m.level(t)) is not None:
                    out.append((k, level))
            if out:
                yield pd.DataFrame(out, columns=["k", "level_no"])

    return d.mapInPandas(run, f"k {kind}, level_no int").groupBy("k").agg(F.min("level_no").alias("level_no")).withColumnRenamed("k", key)
