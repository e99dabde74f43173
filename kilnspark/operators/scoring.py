"""Lexicon scoring: weighted terms over text, as expressions, so a corpus is scored in its scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import phrase_in


def lexicon_score(text: Column, terms: Mapping[str, float]) -> Column:
    """Sum of the weights of the terms in a lower-case text; 0 for NULL."""
    score = F.lit(0.0)
    for t, w in terms.items():
        score = score + F.when(phrase_in(text, t), float(w)).otherwise(0.0)
    return score


def matched_terms(text: Column, terms: Mapping[str, float]) -> Column:
    """The terms found, in lexicon order."""
    return F.array_compact(F.array(*[F.when(phrase_in(text, t), F.lit(t)) for t in terms]))


def score_documents(df: DataFrame, text: str, tiers: Mapping[str, Mapping[str, float]], negative: Mapping[str, float]) -> DataFrame:
    """Adds a score per tier, ``penalty``, ``relevance_score`` (tiers less the penalty, which counts 0.35 with a core hit; floored at 0),
    ``matched`` and ``label`` (core / related / peripheral / none). NULL and empty texts score 0."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    out = df.withColumn("__t", t)
    for name, terms in tiers.items():
        out = out.withColumn(f"{name}_score", lexicon_score(F.col("__t"), terms))
    first = next(iter(tiers))
    total = sum((F.col(f"{n}_score") for n in tiers), F.lit(0.0))
    weight = F.when(F.col(f"{first}_score") > 0, 0.35).otherwise(1.0)
    every = {k: v for terms in tiers.values() for k, v in terms.items()}
    return (
        out.withColumn("penalty", lexicon_score(F.col("__t"), negative))
        .withColumn("relevance_score", F.round(F.greatest(F.lit(0.0), total - F.col("penalty") * weight), 3))
        .withColumn("matched", matched_terms(F.col("__t"), every))
        .withColumn("label", F.when(F.col(f"{first}_score") > 0, "core").when(F.col("relevance_score") >= 3, "related").when(F.col("relevance_score") > 0, "peripheral").otherwise("none"))
        .drop("__t")
    )


def recency_bonus(year: Column, as_of: int, inferred: Column) -> Column:
    """10 less 0.4 a year of age, floored at 0, halved if the year was inferred; 0 without a year."""
    bonus = F.greatest(F.lit(0.0), 10.0 - 0.4 * (F.lit(as_of) - year))
    return F.coalesce(F.when(inferred, bonus / 2).otherwise(bonus), F.lit(0.0))


def pattern_count(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns match."""
    return sum((F.coalesce(text.rlike(p), F.lit(False)).cast("int") for p in patterns), F.lit(0))
