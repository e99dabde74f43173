"""A tree as materialised paths: closure, rollup, missing nodes, membership errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import slug
from ..functions.text import known


def path_of(levels: Sequence[str]) -> Column:
    """Slugs of the levels joined by '/', up to the first missing one; NULL if the first is missing."""
    parts = F.array(*[slug(known(c)) for c in levels])
    return F.transform(F.array(parts), lambda x: _joined(x))[0]  # one evaluation of the slugs


def _joined(parts: Column) -> Column:
    stop = F.array_position(parts, "")
    n = F.when(stop > 0, stop - 1).otherwise(F.size(parts)).cast("int")
    return F.when(n > 0, F.array_join(F.slice(parts, F.lit(1), n), "/"))


def ancestors(path: Column) -> Column:
    """The path and all its prefixes, shortest first; NULL for NULL."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def rollup(df: DataFrame, path: str, aggs: Sequence[Column]) -> DataFrame:
    """(node, level, aggs): every node with what lies on or below it.

    Rows are aggregated by their own path first, then the few paths are spread over their ancestors, so aggregates must be sums
    of sums: give them as (partial, final) of columns named alike.
    """
    own = df.where(F.col(path).isNotNull()).groupBy(path).agg(*aggs)
    names = [c for c in own.columns if c != path]
    spread = own.select(F.explode(ancestors(F.col(path))).alias("node"), *names)
    return spread.groupBy("node").agg(*[F.sum(n).cast("long").alias(n) for n in names]).withColumn("level", F.size(F.split("node", "/")))


def nodes(df: DataFrame, path: str) -> DataFrame:
    """(node, parent, level): all nodes that occur."""
    n = df.where(F.col(path).isNotNull()).select(path).distinct().select(F.explode(ancestors(F.col(path))).alias("node")).distinct()
    level = F.size(F.split("node", "/"))
    return n.select("node", F.when(level > 1, F.array_join(F.slice(F.split("node", "/"), 1, level - 1), "/")).alias("parent"), level.alias("level"))


def conservation_errors(master: DataFrame, parts: DataFrame, path: str) -> DataFrame:
    """(node, total, from_parts): nodes whose rows in ``master`` aren't what ``parts`` hold of the node itself and of its children."""
    t = rollup(master, path, [F.count("*").alias("total")])
    k = rollup(parts, path, [F.count("*").alias("below")])
    own = parts.where(F.col(path).isNotNull()).groupBy(F.col(path).alias("node")).agg(F.count("*").alias("own"))
    up = F.split("node", "/")
    c = k.where("level > 1").groupBy(F.array_join(F.slice(up, 1, F.size(up) - 1), "/").alias("node")).agg(F.sum("below").alias("below"))
    j = t.join(c, "node", "left").join(own, "node", "left").select("node", "total", (F.coalesce("below", F.lit(0)) + F.coalesce("own", F.lit(0))).alias("from_parts"))
    return j.where("total <> from_parts")


def with_zero_nodes(dimension: DataFrame, counts: DataFrame, key: str, count: str) -> DataFrame:
    """Every node of the dimension with its count, 0 where there is none."""
    return dimension.join(counts, key, "left").withColumn(count, F.coalesce(F.col(count), F.lit(0).cast("long")))


def foreign_keys(df: DataFrame, key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """Rows whose key is set and not in the dimension."""
    return df.where(F.col(key).isNotNull()).join(dimension.select(F.col(dim_key).alias(key)).distinct(), key, "left_anti")


def greedy_paths(df: DataFrame, key: str, path: str, score: str, n: int = 3, floor: float = 2.0) -> DataFrame:
    """(key, paths): up to ``n`` paths of a key, best score first (ties: the smaller path), none the ancestor of another, none scored
    more than ``floor`` below the best.

    A fold over the key's distinct paths; their number is bounded by the tree, not by rows, which are aggregated first.
    """
    best = df.where(F.col(key).isNotNull() & F.col(path).isNotNull()).groupBy(key, path).agg(F.max(score).alias("s"))
    arr = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("neg"), F.col(path).alias("p")))).alias("a"))
    near = lambda kept, x: F.exists(kept, lambda y: (y == x["p"]) | F.startswith(y, F.concat(x["p"], F.lit("/"))) | F.startswith(x["p"], F.concat(y, F.lit("/"))))
    fold = F.aggregate(F.filter("a", lambda x: x["neg"] <= F.col("a")[0]["neg"] + floor), F.array().cast("array<string>"), lambda kept, x: F.when((F.size(kept) >= n) | near(kept, x), kept).otherwise(F.array_append(kept, x["p"])))
    return arr.select(key, fold.alias("paths"))


def differences(a: DataFrame, b: DataFrame, only_a: str, only_b: str) -> DataFrame:
    """(side, columns): the distinct rows that one of two tables has and the other lacks."""
    return a.subtract(b).select(F.lit(only_a).alias("side"), *a.columns).unionAll(b.subtract(a).select(F.lit(only_b), *a.columns))
