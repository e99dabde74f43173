"""Lookups by host suffix, by contained names and by citation marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import key_fold


def by_host_suffix(df: DataFrame, host: str, rules: DataFrame, suffix: str) -> DataFrame:
    """Each row with the rule of the longest suffix of its host (equal or behind a dot); NULLs where none fits.

    Distinct hosts are expanded to their suffixes and equi-joined, so there is no pairwise comparison.
    """
    parts = F.split(F.col(host), r"\.")
    hosts = df.where(F.col(host).isNotNull()).select(host).distinct()
    suffixes = hosts.select(host, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))).alias(suffix))
    other = [c for c in rules.columns if c != suffix]
    hit = suffixes.join(rules, suffix).groupBy(host).agg(F.max(F.struct(F.length(suffix).alias("n"), F.col(suffix), *other)).alias("b")).select(host, F.col(f"b.{suffix}").alias(suffix), *[F.col(f"b.{c}").alias(c) for c in other])
    return df.join(hit, host, "left")


def contained_names(texts: DataFrame, text_id: str, text: str, names: DataFrame, name_id: str, name: str) -> DataFrame:
    """(text_id, name_id): names whose folded form stands in the folded text as whole words.

    Runs of words of the texts, of the lengths that names have, meet the names by equality.
    """
    n = names.select(name_id, key_fold(name).alias("k")).where("k <> ''").withColumn("w", F.size(F.split("k", " ")))
    longest = n.agg(F.max("w")).first()[0] or 0
    words = F.split(key_fold(text), " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max(1, longest))), lambda w: F.when(F.size(words) >= w, F.transform(F.sequence(F.lit(1), F.size(words) - w + 1), lambda i: F.array_join(F.slice(words, i, w), " "))).otherwise(F.array().cast("array<string>"))))
    t = texts.select(text_id, F.explode(F.array_distinct(runs)).alias("k"))
    return t.join(n.select(name_id, "k"), "k").select(text_id, name_id).distinct()


def citation_marks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, citation, n): numbers in square brackets of each text and how often each stands there."""
    return df.select(key, F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"\[([0-9]+)\]"), F.lit(1))).alias("c")).groupBy(key, F.col("c").cast("int").alias("citation")).agg(F.count("*").alias("n"))
