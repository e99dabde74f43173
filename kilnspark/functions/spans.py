"""Evidence spans: the sentence of a text that supports a claim best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def spans(text: Column) -> Column:
    """Candidate spans: pieces between '. ', blanks squeezed, empty ones left out."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")
    return F.filter(F.transform(F.split(s, r"\. "), lambda x: F.trim(x)), lambda x: x != "")


def best_span(text: Column, terms: Sequence[str]) -> Column:
    """struct(score, span): the span with most of the terms, the first one on a tie; NULL if no span has any."""
    hits = lambda x: sum((F.lower(x).contains(t).cast("int") for t in terms), F.lit(0))
    scored = F.transform(spans(text), lambda x, i: F.struct(hits(x).alias("score"), (-i).alias("back"), x.alias("span")))
    best = F.array_max(F.filter(scored, lambda x: x["score"] > 0))
    return F.when(best.isNotNull(), F.struct(best["score"].alias("score"), best["span"].alias("span")))


def numeric_span(text: Column, unit: str) -> Column:
    """The shortest span that holds a number before the unit, the first one on a tie; NULL if none."""
    ok = F.filter(F.transform(spans(text), lambda x, i: F.struct(F.length(x).alias("n"), i.alias("i"), x.alias("span"))), lambda x: x["span"].rlike(rf"(?i)[0-9] {unit}"))
    return F.array_min(ok)["span"]
