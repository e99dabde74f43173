"""Integrity of partitioned and merged tables: multisets, leakage, citations, named checks, manifests, counters of several groupings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import known, present


def multiset_difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, in_first, in_second): rows whose number differs between two tables. One shuffle of both sides' partial counts, where
    exceptAll both ways takes four."""
    x = a.select(*columns, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionAll(b.select(*columns, F.lit(0), F.lit(1)))
    return x.groupBy(*columns).agg(F.sum("__a").alias("in_first"), F.sum("__b").alias("in_second")).where("in_first <> in_second")


def leaked(df: DataFrame, key: str, part: Column, own: Column) -> DataFrame:
    """(key, part, own): rows that stand in another partition than their own."""
    return df.select(key, part.alias("part"), own.alias("own")).where(~F.col("part").eqNullSafe(F.col("own"))).distinct()


def in_several(df: DataFrame, key: str, part: str) -> DataFrame:
    """(key, parts): keys that stand in several partitions, and in how many."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(part).alias("parts")).where("parts > 1")


def both_ways(a: DataFrame, a_key: str, b: DataFrame, b_key: str, only_a: str, only_b: str) -> DataFrame:
    """(side, key): keys of each table that the other lacks, as two anti-joins would give them, from one aggregation."""
    x = a.select(F.col(a_key).alias("key"), F.lit(1).alias("bit")).unionAll(b.select(F.col(b_key), F.lit(2))).where("key IS NOT NULL")
    g = x.groupBy("key").agg(F.bit_or("bit").alias("bits")).where("bits < 3")
    return g.select(F.when(F.col("bits") == 1, only_a).otherwise(only_b).alias("side"), "key")


def checks(named: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(check_name, status, failed): how many rows fail each check (table, condition of a failed row); 'pass' where none does."""
    out = None
    for name, (df, bad) in named.items():
        one = df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("failed")).select(F.lit(name).alias("check_name"), F.when(F.col("failed") == 0, "pass").otherwise("fail").alias("status"), "failed")
        out = one if out is None else out.unionAll(one)
    return out


def manifest(df: DataFrame, distinct: Sequence[str], filled: Sequence[str], spans: Sequence[str]) -> DataFrame:
    """(name, value): rows, distinct values of some columns, filled ones of others, least and greatest of others, in one pass; as text."""
    d = df.agg(
        F.count("*").cast("string").alias("rows"), *[F.countDistinct(c).cast("string").alias(f"distinct {c}") for c in distinct], *[F.count_if(present(c)).cast("string").alias(f"filled {c}") for c in filled],
        *[x for c in spans for x in (F.min(c).cast("string").alias(f"least {c}"), F.max(c).cast("string").alias(f"greatest {c}"))],
    )
    return d.unpivot([], d.columns, "name", "value")


def counts_by(df: DataFrame, groupings: Mapping[str, Column]) -> DataFrame:
    """(grouping, value, n): counts by each of several expressions, from one pass: a row becomes one row per grouping, summed up in the tasks."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("grouping"), c.cast("string").alias("value")) for n, c in groupings.items()])).alias("x")).select("x.*")
    return long.groupBy("grouping", "value").agg(F.count("*").alias("n"))


def profile(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], distinct: Mapping[str, Column]) -> DataFrame:
    """Per partition: rows, how often each flag holds, distinct values of each expression (NULLs don't count)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()], *[F.countDistinct(c).alias(n) for n, c in distinct.items()])


def coverage(nodes: DataFrame, node: str, facts: Mapping[str, tuple[DataFrame, Column, Column]]) -> DataFrame:
    """Nodes with a count per fact, 0 where there is none, and ``uncovered`` for nodes without any. ``facts`` are name -> (table, node, aggregate);
    every fact is aggregated before it meets the nodes."""
    out = nodes
    for name, (df, key, agg) in facts.items():
        out = out.join(df.groupBy(key.alias(node)).agg(agg.alias(name)), node, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    none = F.lit(True)
    for name in facts:
        none = none & (F.col(name) == 0)
    return out.withColumn("uncovered", none)


def buckets(df: DataFrame, keys: Sequence[str], first: str, second: str, warn: float = 0.2) -> DataFrame:
    """Per key: leaves with the first fact only, the second only, both, none, and ``warn`` where the share of none is above a threshold."""
    a, b = F.col(first) > 0, F.col(second) > 0
    g = df.groupBy(*keys).agg(F.count_if(a & ~b).alias("first_only"), F.count_if(b & ~a).alias("second_only"), F.count_if(a & b).alias("both"), F.count_if(~a & ~b).alias("none"), F.count("*").alias("leaves"))
    return g.withColumn("warn", F.col("none") > warn * F.col("leaves"))


def required(df: DataFrame, key: str, wanted: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """(key, problem): wanted keys without a row ('missing'), and rules that a key's rows break, each once."""
    w = df.sparkSession.createDataFrame([(x,) for x in wanted], "k string")
    lost = w.join(df.select(F.col(key).alias("k")).distinct(), "k", "left_anti").select(F.col("k").alias(key), F.lit("missing").alias("problem"))
    broken = df.select(key, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("problem")).distinct()
    return lost.unionAll(broken)


def merge_counters(df: DataFrame, keys: Sequence[str], counters: Sequence[str], warnings: str, most: int = 1000) -> DataFrame:
    """Per key: sums of the counters, how many distinct warnings there are, and the first ``most`` of them in order of the alphabet (a report)."""
    from .ranking import top_per_group

    sums = df.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in counters])
    w = df.select(*keys, F.trim(known(warnings)).alias("w")).where("w IS NOT NULL").distinct()
    first = top_per_group(w, keys, [F.col("w")], most).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("w")), " | ").alias("warnings"))
    n = w.groupBy(*keys).agg(F.count("*").alias("n_warnings"))
    return sums.join(n, list(keys), "left").join(first, list(keys), "left").withColumns({"n_warnings": F.coalesce("n_warnings", F.lit(0).cast("bigint")), "warnings": F.coalesce("warnings", F.lit(""))})


def merge_shards(df: DataFrame, shard: str, ids: Sequence[str], planned: DataFrame, states: Mapping[str, Column]) -> DataFrame:
    """(name, n): what a merge of shards must know: rows, ids that stand twice, planned shards without rows, rows in each state."""
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in states.items()])
    out = one.unpivot([], one.columns, "name", "n")
    for i in ids:
        out = out.unionAll(df.groupBy(i).agg(F.count("*").alias("c")).where(F.col(i).isNotNull() & (F.col("c") > 1)).agg(F.count("*").alias("n")).select(F.lit(f"{i} twice").alias("name"), "n"))
    lost = planned.select(shard).distinct().join(df.select(shard).distinct(), shard, "left_anti").agg(F.count("*").alias("n"))
    return out.unionAll(lost.select(F.lit("shards missing").alias("name"), "n"))
