"""Extraction as a plug-in: any function from a record to rows, with failures kept as rows and results cached; a deterministic classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon
from .ranking import best_per_key

Extractor = Callable[[dict], Iterable[Mapping]]


def extract(df: DataFrame, key: str, extractor: Extractor, schema: str) -> DataFrame:
    """(key, schema, row_no, error): the rows that ``extractor`` makes of each record (a dict of its columns), numbered from 1.

    A record that gives no rows keeps one of NULLs; one that raises keeps one with the error's type and message, so that one bad record costs
    nothing but itself. Records go through in Arrow batches, as many at a time as the session's tasks; an extractor that calls a model or the
    network brings its own retries.
    """
    columns = df.sparkSession.createDataFrame([], schema).columns
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                try:
                    rows = [dict(x) for x in extractor(r)]
                    found = [(r[key], *(x.get(c) for c in columns), n, None) for n, x in enumerate(rows, 1)] or [(r[key], *(None for _ in columns), 0, None)]
                except Exception as e:  # the record's own failure is data
                    found = [(r[key], *(None for _ in columns), 0, f"{type(e).__name__}: {e}")]
                out += found
            yield pd.DataFrame(out, columns=[key, *columns, "row_no", "error"])

    return df.mapInPandas(run, f"`{key}` {kind}, {schema}, row_no int, error string")


def cached(df: DataFrame, parts: Sequence[Column], cache: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of the records, taken from ``cache`` (cache_key and its columns) where their key is there; only the others are built.

    The key is the SHA-256 of the parts, so another model or prompt version is another key.
    """
    keyed = df.withColumn("cache_key", F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256))
    fresh = build(keyed.join(cache.select("cache_key").distinct(), "cache_key", "left_anti"))
    old = cache.join(keyed.select("cache_key").distinct(), "cache_key", "left_semi")
    return old.withColumn("from_cache", F.lit(True)).unionByName(fresh.withColumn("from_cache", F.lit(False)))


def classify(texts: DataFrame, key: str, text: str, cues: DataFrame, negative: DataFrame, weight: float = 2.0, penalty: float = 3.0) -> DataFrame:
    """(key, node, score): the node with most of its cues (node, term) in a text, ``weight`` each, less ``penalty`` for each of its negative cues;
    ties go to the smaller node, texts without a node above 0 are left out."""
    terms = cues.select("node", "term", F.lit(weight).alias("weight")).unionAll(negative.select("node", "term", F.lit(-penalty)))
    s = lexicon.node_scores(texts, key, text, terms).where("score > 0")
    return best_per_key(s, [key], [F.desc("score"), F.col("node")]).select(key, "node", "score")


def paths_of_answer(json: Column, levels: int) -> Column:
    """The distinct label paths (arrays) of an answer {"paths": [["a", "b"], ...]}, each of at most ``levels`` labels, blanks left out."""
    found = F.from_json(json, "struct<paths:array<array<string>>>")["paths"]
    clean = F.transform(F.coalesce(found, F.array().cast("array<array<string>>")), lambda p: F.slice(F.filter(F.transform(p, lambda x: F.trim(x)), lambda x: x != ""), 1, levels))
    return F.array_distinct(F.filter(clean, lambda p: F.size(p) > 0))


def expand(df: DataFrame, keys: Sequence[str], json: str, inner: str, schema: str) -> DataFrame:
    """(keys, record_no, item_no, schema): records of an answer {"records": [...]} and in each the items of its list ``inner``, both numbered from
    1; a record without items keeps a row."""
    t = f"struct<records:array<struct<{inner}:array<struct<{schema}>>>>>"
    r = df.select(*keys, F.posexplode(F.from_json(json, t)["records"]).alias("__r", "__x"))
    i = r.select(*keys, (F.col("__r") + 1).alias("record_no"), F.posexplode_outer(F.col("__x")[inner]).alias("__i", "__y"))
    return i.select(*keys, "record_no", (F.coalesce("__i", F.lit(0)) + 1).alias("item_no"), "__y.*")
