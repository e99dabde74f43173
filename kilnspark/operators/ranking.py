"""Best per key, top per group, shards, fair caps, samples, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``. The rank filter becomes a group limit before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank_no") -> DataFrame:
    """The first ``n`` rows of each group with their rank; the rank filter prunes before and after the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of all; each task keeps ``n`` (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def shard_no(position: Column, size: int) -> Column:
    """The contiguous shard of a position, from 0."""
    return F.floor(position / size).cast("long")


def round_robin_cap(df: DataFrame, group: str, order: Sequence[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows, the first of every group before any second, and so on; groups in order of their key."""
    ranked = df.withColumn("turn", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("turn") <= cap)  # prunes hot groups early
    return ranked.orderBy("turn", group).limit(cap)


def hash_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """Exactly ``n`` rows (or all), the same for the same seed: those of the smallest sha1 of key and seed."""
    return df.orderBy(F.sha1(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), F.col(key)).limit(n)


def islands(df: DataFrame, group: Sequence[str], number: str, block: int = 100_000) -> DataFrame:
    """(group, first_no, last_no, n): runs of consecutive numbers; repeated numbers count once, NULLs don't.

    Runs are found within blocks of ``block`` numbers, so a hot group is spread over tasks; only the runs that touch a block's
    border, two a block at most, are then put together.
    """
    n = F.col(number)
    d = df.select(*group, n.cast("long").alias("__n")).where(n.isNotNull()).distinct().withColumn("__b", F.floor(F.col("__n") / block))
    d = d.withColumn("__run", F.col("__n") - F.row_number().over(W.partitionBy(*group, "__b").orderBy("__n")))
    runs = d.groupBy(*group, "__b", "__run").agg(F.min("__n").alias("first_no"), F.max("__n").alias("last_no"), F.count("*").alias("n"))
    at_border = (F.col("first_no") == F.col("__b") * block) | (F.col("last_no") == F.col("__b") * block + (block - 1))
    runs = runs.withColumn("__border", at_border).drop("__run", "__b")
    w = W.partitionBy(*group).orderBy("first_no")
    border = runs.where("__border").withColumn("__new", (F.coalesce(F.lag("last_no").over(w), F.col("first_no") - 2) != F.col("first_no") - 1).cast("long"))
    border = border.withColumn("__id", F.sum("__new").over(w)).groupBy(*group, "__id").agg(F.min("first_no").alias("first_no"), F.max("last_no").alias("last_no"), F.sum("n").alias("n"))
    return runs.where("NOT __border").select(*group, "first_no", "last_no", "n").unionByName(border.drop("__id"))
