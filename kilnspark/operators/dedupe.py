"""Exact and near duplicates by keys, with an audit trail; superseding rows; provenance of merged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import digest
from ..functions.text import present
from .ranking import best_per_key


def mark_duplicates(df: DataFrame, exact: Sequence[str], semantic: Sequence[str], order: str) -> DataFrame:
    """Adds ``exact_key``, ``semantic_key``, ``dup_status`` and ``dup_of``.

    The first row of an exact key by ``order`` (unique) survives, later ones are 'exact' with the survivor's order value; survivors
    that share a semantic key with an earlier survivor are 'possible' with the first one's; others are 'unique'. Two missing
    parts match each other.

    First rows come from partial aggregations and are joined back, one row a key, so a key in a third of all rows is never
    sorted in one task; the join's large side is split by AQE.
    """
    return mark_by_keys(df.withColumn("exact_key", digest(*exact)).withColumn("semantic_key", F.substring(digest(*semantic), 1, 16)), order)


def mark_by_keys(d: DataFrame, order: str) -> DataFrame:
    """Adds ``dup_status`` and ``dup_of`` to rows that have their ``exact_key`` and ``semantic_key``, as :func:`mark_duplicates` does."""
    e = d.groupBy("exact_key").agg(F.min(F.struct(F.col(order).alias("o"), "semantic_key")).alias("f")).select("exact_key", F.col("f.o").alias("__first"), F.col("f.semantic_key").alias("__s"))
    s = e.groupBy("__s").agg(F.min("__first").alias("__sfirst"))
    j = d.join(e.join(s, "__s").drop("__s"), "exact_key")
    again, alike = F.col(order) != F.col("__first"), F.col("__first") != F.col("__sfirst")
    j = j.withColumn("dup_status", F.when(again, "exact").when(alike, "possible").otherwise("unique"))
    return j.withColumn("dup_of", F.when(again, F.col("__first")).when(alike, F.col("__sfirst"))).drop("__first", "__sfirst")


def superseded(df: DataFrame, key: str, failed: Column, order: str) -> DataFrame:
    """One row per key: the first success, or the first failure if there is none."""
    return best_per_key(df.withColumn("__bad", failed.cast("int")), [key], [F.col("__bad"), F.col(order)]).drop("__bad")


def with_provenance(df: DataFrame, key: str, origin: str, order: Sequence[Column]) -> DataFrame:
    """The first row per key with ``n_origins`` (distinct) and ``n_rows`` of all rows of the key; :func:`provenance` names the origins, a row
    each, so that no key's origins meet in one row."""
    o = df.groupBy(key, origin).agg(F.count("*").alias("n"))
    who = o.groupBy(key).agg(F.count(origin).alias("n_origins"), F.sum("n").alias("n_rows"))
    return best_per_key(df, [key], order).join(who, key)


def provenance(df: DataFrame, key: str, origin: str) -> DataFrame:
    """(key, origin): the distinct origins of each key; NULL origins are none."""
    return df.where(F.col(origin).isNotNull()).select(key, origin).distinct()


def audit_rows(marked: DataFrame, key: str, order: str) -> DataFrame:
    """(key, group_id, dup_status, reason, matched): one row per row that is no first, from :func:`mark_duplicates`."""
    m = marked.where("dup_status <> 'unique'")
    exact = F.col("dup_status") == "exact"
    return m.select(key, F.when(exact, F.substring("exact_key", 1, 12)).otherwise(F.col("semantic_key")).alias("group_id"), "dup_status", F.when(exact, "same technology, source, project and metrics").otherwise("same technology, source, project and company").alias("reason"), F.col("dup_of").alias("matched"))


def ordered_distinct(df: DataFrame, key: Column, order: Sequence[Column], most: int) -> DataFrame:
    """The first row of each key by ``order``, then the first ``most`` of those in that order; rows without a key are left out."""
    d = df.withColumn("__key", key).where("__key IS NOT NULL AND __key <> ''")
    return best_per_key(d, ["__key"], order).orderBy(*order).limit(most).drop("__key")


def keep_blank_ids(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each id by ``order``, and every row without an id."""
    has = present(key)
    return best_per_key(df.where(has), [key], order).unionByName(df.where(~has))
